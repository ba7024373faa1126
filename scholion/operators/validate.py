"""Rules on typed records beyond their shape: numeric bounds and distinct entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholion.functions.arrays import dedup_by, dedup_ignore_case
from scholion.functions.text import strip

NOT_NEGATIVE, POSITIVE, PERCENT = "must be >= 0", "must be > 0", "must be within [0, 100]"

# Numeric bounds of the first-generation records, as (path, rule).
BOUNDS = {
    "synthesis_v1": [(f"synthesis.crystallization.{n}", NOT_NEGATIVE) for n in ("temp_c", "time_d", "agitation_rpm")],
    "application_v1": [("application.regeneration.temp_c", NOT_NEGATIVE),
                       ("application.regeneration.yield_percent", PERCENT)],
    "characterization_v1": (
        [(f"characterization.crystal_size.{n}", NOT_NEGATIVE) for n in ("a_axis_nm", "b_axis_nm", "c_axis_nm", "average_nm")]
        + [("characterization.si_al_ratio_actual", POSITIVE)]
        + [(f"characterization.porosity.{n}", NOT_NEGATIVE) for n in ("bet_m2_g", "v_total_cm3_g", "v_micro_cm3_g", "v_meso_cm3_g")]
        + [("characterization.acidity.b_l_ratio", NOT_NEGATIVE)]),
}


def rules(kind: str, record: Column) -> list[tuple[str, Column]]:
    """(message, condition that must hold) pairs for ``parse_responses``."""
    out = []
    for path, rule in BOUNDS[kind]:
        value = record
        for name in path.split("."):
            value = value[name]
        holds = {NOT_NEGATIVE: value >= 0, POSITIVE: value > 0, PERCENT: value.between(0, 100)}[rule]
        out.append((f"{path.rsplit('.', 1)[1]} {rule}", holds))
    return out


def rule_errors(record: Column, kind: str) -> Column:
    """Messages of the broken rules; missing values break none."""
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(ok, F.lit(True)), F.lit(message)) for message, ok in rules(kind, record)]))


def _fold(text: Column) -> Column:
    return F.lower(strip(F.coalesce(text, F.lit(""))))


def clean_main_signal(record: Column) -> Column:
    """Aliases distinct and different from the name; samples equal in five fields once."""
    def key(s: Column) -> Column:
        return F.concat_ws("\x1f", *[_fold(s[n]) for n in ("name", "category_code", "sample_form", "structure_l1", "structure_l2")])

    samples = dedup_by(F.transform(record["samples"], lambda s: s.withField("aliases", F.filter(
        dedup_ignore_case(s["aliases"]), lambda a: _fold(a) != _fold(s["name"])))), key)
    return record.withField("samples", samples)


def clean_material_ids(record: Column) -> Column:
    """Materials with equal ids (ignoring case) once."""
    return record.withField("material_ids", dedup_by(record["material_ids"], lambda m: _fold(m["id"])))
