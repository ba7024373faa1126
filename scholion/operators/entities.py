"""Record shapes: field names, answer keys and the Spark types derived from them.

Answers of the model use the keys in the second place of each field; tables use the
English names in the first place. Structs of both namings have the same field order,
so a cast renames.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT, UNION, NUMBER, TEXTS = "text", "union", "number", "texts"


@dataclass(frozen=True)
class Entity:
    """Fields as (name, answer key, kind); kind is a scalar kind, an Entity or [Entity].

    Keys that are no field are ignored; ``strict`` reports them, ``open`` keeps them.
    """

    fields: tuple
    required: tuple[str, ...] = ()
    open: bool = False
    strict: bool = False
    renames: dict[str, str] = field(default_factory=dict)

    def __hash__(self) -> int:
        return hash(self.fields)


def strict(entity: Entity) -> Entity:
    """The entity and all within it, reporting unknown keys where they aren't kept."""
    def one(kind):
        return strict(kind) if isinstance(kind, Entity) else [strict(kind[0])] if isinstance(kind, list) else kind

    return replace(entity, fields=tuple((n, k, one(kind)) for n, k, kind in entity.fields), strict=not entity.open)


def _text_fields(*pairs: tuple[str, str]) -> tuple:
    return tuple((name, key, TEXT) for name, key in pairs)


# The keys of the answers.
LITERATURE = Entity((
    ("literature_id", "唯一文献标识", TEXT), ("title", "论文标题", TEXT), ("authors", "作者列表", TEXTS),
    ("journal", "期刊名称", TEXT), ("year", "年份", UNION), ("volume", "卷号", UNION), ("pages", "页码", TEXT),
    ("document_type", "文档类型", TEXT), ("language", "语言", TEXT), ("keywords", "关键词", TEXTS),
))
SAMPLE = Entity((
    ("name", "名称", TEXT), ("aliases", "别名", TEXTS), ("category_name", "聚合物分类名称", TEXT),
    ("category_code", "聚合物分类编码", TEXT), ("sample_form", "样本形态", TEXT), ("structure_l1", "结构特征_L1", TEXT),
    ("structure_l2", "结构特征_L2", TEXT),
), required=("name",))
MAIN_SIGNAL = Entity((
    ("literature", "文献信息", LITERATURE), ("samples", "聚合物", [SAMPLE]), ("why", "why", TEXT),
), required=("literature", "why"))

_METHOD = (("instrument", "仪器", TEXT), ("note", "说明", TEXT))
CHARACTERIZATION = Entity((
    ("ftir", "红外_FTIR", Entity(_METHOD + (("peaks_cm_1", "峰位_cm_1", TEXTS), ("characteristic_peaks", "特征峰位", TEXTS)))),
    ("uv_vis", "紫外_UVVis", Entity(_METHOD + (("absorption_peaks_nm", "吸收峰_nm", TEXTS), ("lambda_max_nm", "λmax_nm", TEXTS)))),
    ("gpc_sec", "分子量_GPC_SEC", Entity(_METHOD + (
        ("mobile_phase", "流动相", TEXT), ("temperature", "温度", TEXT), ("calibration", "校准", TEXT),
        ("mn_kda", "Mn_kDa", UNION), ("mw_kda", "Mw_kDa", UNION), ("pdi", "PDI", UNION)))),
    ("nmr", "核磁_NMR", Entity(_METHOD + (
        ("solvent", "溶剂", TEXT), ("frequency_mhz", "频率_MHz", UNION), ("h1", "H1_NMR", TEXT), ("c13", "C13_NMR", TEXT)))),
    ("xrd_waxs", "XRD_WAXS", Entity(_METHOD + (("peaks_2theta", "峰位_2theta", TEXTS),))),
    ("mass_spec", "质谱_LCMS", Entity(_METHOD + (("mode", "模式", TEXT), ("peaks_m_z", "特征峰_m_z", TEXTS)))),
    ("raman", "拉曼_Raman", Entity(_METHOD + (("peaks_cm_1", "峰位_cm_1", TEXTS),))),
    ("xps", "XPS", Entity(_METHOD + (("peaks_ev", "峰位_eV", TEXTS), ("elements", "元素与价态", TEXTS)))),
    ("morphology", "形貌", Entity(_METHOD + _text_fields(("sem", "SEM"), ("tem", "TEM"), ("afm", "AFM"), ("microscopy", "显微")))),
    ("bet", "BET比表面积", Entity(_METHOD + (
        ("surface_area_m2_g", "比表面积_m2_g", UNION), ("pore_size_nm", "孔径_nm", UNION), ("pore_volume_cm3_g", "孔容_cm3_g", UNION)))),
    ("contact_angle", "接触角", Entity(_METHOD + (("angles_deg", "接触角_deg", TEXTS),))),
    ("elemental", "元素分析", Entity(_METHOD + (("composition", "元素组成", TEXTS),))),
))
CHAR_RESULT = strict(Entity((("characterization", "表征", CHARACTERIZATION), ("why", "why", TEXT))))

SCALAR_VALUE = Entity((
    ("single", "单值", UNION), ("minimum", "最小", UNION), ("maximum", "最大", UNION), ("unit", "单位", TEXT),
    ("error", "误差", UNION), ("note", "说明", TEXT),
))
TEST_CONDITIONS = Entity(_text_fields(
    ("sample", "样品"), ("sample_size", "样品尺寸"), ("method", "方法"), ("instrument", "仪器"),
    ("pretreatment", "样品预处理"), ("surface_treatment", "表面处理"), ("atmosphere", "气氛"),
    ("parameters", "测量参数"), ("working_distance", "工作距离"), ("working_time", "工作时间"),
    ("working_temperature", "工作温度")) + (
    ("temperature", "测试温度", SCALAR_VALUE), ("temperature_range", "测试温度范围", SCALAR_VALUE),
    ("heating_rate", "升温速率", SCALAR_VALUE), ("cooling_rate", "降温速率", SCALAR_VALUE),
    ("scan_range", "温度扫描范围", SCALAR_VALUE), ("scan_rate", "温度扫描速率", SCALAR_VALUE)), open=True)
PROPERTY = Entity((
    ("category", "类别", TEXT), ("name", "名称", TEXT), ("abbreviation", "缩写", TEXT), ("value", "值", SCALAR_VALUE),
    ("conditions", "测试条件", TEST_CONDITIONS),
), required=("category", "name", "value", "conditions"))
PROP_RESULT = strict(Entity((("properties", "性质", [PROPERTY]), ("why", "why", TEXT))))

PROCESS_VALUE = Entity((("single", "单值", UNION), ("unit", "单位", TEXT)))
MATERIAL = Entity(_text_fields(
    ("name", "原料名称"), ("material_class", "原料类别"), ("material_type", "原料类型"), ("iupac_name", "IUPAC名称"),
    ("abbreviation", "缩写"), ("formula", "分子式"), ("smiles", "SMILES"), ("cas", "CAS号"), ("inchi", "InChI"),
    ("feeding", "投料方式"), ("model", "型号"), ("source", "来源")) + (
    ("mass", "质量", PROCESS_VALUE), ("volume", "体积", PROCESS_VALUE), ("amount", "摩尔量", PROCESS_VALUE),
    ("ratio", "当量比", PROCESS_VALUE), ("purity", "纯度", PROCESS_VALUE)),
    required=("name",), open=True, renames={"单体类型": "原料类型", "smiles": "SMILES", "inchi": "InChI"})
CONDITION = Entity((
    ("device", "反应装置", TEXT), ("atmosphere", "反应气氛", TEXT), ("temperature", "反应温度", PROCESS_VALUE),
    ("solvent", "溶剂", TEXT), ("solvent_amount", "溶剂量", PROCESS_VALUE), ("time", "反应时间", PROCESS_VALUE),
    ("procedure", "制备过程", TEXT), ("conditions", "反应条件", TEXT)), open=True)
LOCATION = Entity(_text_fields(("block_id", "block_id"), ("md_range", "md_range"), ("text", "原文")))
STEP = Entity((
    ("product_name", "产物名称", TEXT), ("product_mass", "产物质量", NUMBER), ("product_unit", "产物单位", TEXT),
    ("yield_percent", "产物收率百分比", NUMBER), ("materials", "原料", [MATERIAL]), ("conditions", "反应条件", [CONDITION]),
    ("post_processing", "后处理步骤", TEXTS), ("location", "位置索引", LOCATION),
), required=("product_name",))
PROC_RESULT = strict(Entity((("steps", "工艺流程", [STEP]), ("why", "why", TEXT))))

ROUTE_RESULT = {"main": MAIN_SIGNAL, "char": CHAR_RESULT, "prop": PROP_RESULT, "proc": PROC_RESULT}

# first generation: answer keys equal field names
def _same(*fields: tuple) -> tuple:
    return tuple((f[0], f[0], f[1]) for f in fields)


MATERIAL_ID = Entity(_same(("id", TEXT), ("aliases", TEXTS), ("framework_code", TEXT), ("why", TEXT)),
                     required=("id", "why"))
MATERIAL_IDS = Entity(_same(("material_ids", [MATERIAL_ID]), ("paper_frameworks", TEXTS), ("why", TEXT)),
                      required=("why",))
CRYSTALLIZATION = Entity(_same(("temp_c", NUMBER), ("time_d", NUMBER), ("agitation_rpm", NUMBER)))
SYNTHESIS = Entity(_same(
    ("zeolite_type", TEXT), ("gel_composition", TEXT), ("template", TEXT), ("silica_source", TEXT),
    ("aluminium_source", TEXT), ("crystallization", CRYSTALLIZATION), ("post_treatment_steps", TEXTS)))
SYNTHESIS_RESULT = Entity(_same(("material_id", TEXT), ("synthesis", SYNTHESIS), ("why", TEXT)),
                          required=("material_id",))
_VALUE_UNIT = Entity(_same(("value", NUMBER), ("unit", TEXT)))
APPLICATION = Entity(_same(
    ("scenario", TEXT), ("target_species", TEXT), ("capacity", _VALUE_UNIT), ("selectivity", _VALUE_UNIT),
    ("breakthrough", _VALUE_UNIT), ("regeneration", Entity(_same(("temp_c", NUMBER), ("yield_percent", NUMBER))))))
APPLICATION_RESULT = Entity(_same(("application", APPLICATION), ("why", TEXT)))
CHARACTERIZATION_V1 = Entity(_same(
    ("morphology", TEXT),
    ("crystal_size", Entity(_same(("a_axis_nm", NUMBER), ("b_axis_nm", NUMBER), ("c_axis_nm", NUMBER), ("average_nm", NUMBER)))),
    ("si_al_ratio_actual", NUMBER),
    ("porosity", Entity(_same(("bet_m2_g", NUMBER), ("v_total_cm3_g", NUMBER), ("v_micro_cm3_g", NUMBER), ("v_meso_cm3_g", NUMBER)))),
    ("acidity", Entity(_same(("bronsted_acid_amount_mmol_g", NUMBER), ("lewis_acid_amount_mmol_g", NUMBER), ("b_l_ratio", NUMBER))))))
CHARACTERIZATION_V1_RESULT = Entity(_same(("characterization", CHARACTERIZATION_V1), ("why", TEXT)))

UNION_TYPE = T.StructType([T.StructField("text", T.StringType()), T.StructField("is_number", T.BooleanType())])
EXTRA = "extra"


def answer_schema(entity: Entity) -> T.StructType:
    """Schema to read an answer with; mixed scalars and open objects stay variants."""
    def one(kind) -> T.DataType:
        if isinstance(kind, Entity):
            return T.VariantType() if kind.open else answer_schema(kind)
        if isinstance(kind, list):
            return T.ArrayType(one(kind[0]))
        if kind == TEXT:
            return T.StringType()
        return T.VariantType()

    return T.StructType([T.StructField(key, one(kind)) for _, key, kind in entity.fields])


def table_schema(entity: Entity, by_key: bool = False) -> T.StructType:
    """Schema of the typed record, under English names or (``by_key``) answer keys."""
    def one(kind) -> T.DataType:
        if isinstance(kind, Entity):
            return table_schema(kind, by_key)
        if isinstance(kind, list):
            return T.ArrayType(one(kind[0]))
        return {TEXT: T.StringType(), UNION: UNION_TYPE, NUMBER: T.DoubleType(),
                TEXTS: T.ArrayType(T.StringType())}[kind]

    fields = [T.StructField(key if by_key else name, one(kind)) for name, key, kind in entity.fields]
    if entity.open:
        fields.append(T.StructField(EXTRA, T.MapType(T.StringType(), T.StringType())))
    return T.StructType(fields)


def to_reference_names(df: DataFrame, column: str, entity: Entity) -> DataFrame:
    """Rename the nested fields of a record column to the answer keys."""
    kind = table_schema(entity, by_key=True)
    if isinstance(df.schema[column].dataType, T.ArrayType):
        kind = T.ArrayType(kind)
    return df.withColumn(column, F.col(column).cast(kind))


def leaf_text(value: Column) -> Column:
    return F.when(value.isNotNull(), value["text"])
