"""Fixed values of the routing rules: forms, form groups, markers and line shapes."""

from __future__ import annotations

# Physical forms and the words that name them.
FORM_WORDS = {
    "char": {
        "Aerogel": ("aerogel",), "Film": ("film",), "Membrane": ("membrane",), "Ink": ("ink",),
        "Solution": ("solution",), "Gel": ("gel",), "Powder": ("powder",), "Foam": ("foam",),
        "Fiber": ("fiber", "fibre"), "Coating": ("coating",),
    },
}
FORM_WORDS["prop"] = {**FORM_WORDS["char"], "Solid": ("solid",)}
FORM_WORDS["proc"] = {
    **FORM_WORDS["prop"], "Substrate": ("substrate",), "Electrode": ("electrode",), "Sensor": ("sensor",),
    "Device": ("device",),
}
# Plural endings a form word may carry.
FORM_PLURAL = {"char": "(?:s|es)?", "prop": "", "proc": "s?"}
PLURAL_ENDINGS = {"char": ("", "s", "es"), "prop": ("",), "proc": ("", "s")}

# Groups of forms.
FORM_GROUPS = {
    "Aerogel": "PorousBody", "Foam": "PorousBody",
    "Film": "ThinLayer", "Membrane": "ThinLayer", "Coating": "ThinLayer",
    "Substrate": "SupportedNode", "Electrode": "SupportedNode", "Sensor": "SupportedNode", "Device": "SupportedNode",
    "Ink": "PrecursorFluid", "Solution": "PrecursorFluid", "Gel": "PrecursorFluid",
    "Powder": "Powder", "Fiber": "Fiber", "Solid": "Solid",
}
FLUID_FORMS = ("Ink", "Solution", "Gel")

# Category names too general to identify a sample.
GENERIC_CATEGORY_NAMES = ("polyimide", "polyamic acid", "polyamic acid ammonium salt", "cellulose nanocrystal",
                          "cellulose nanocrystals")

# Line and phrase shapes.
RATIO = r"(?iU)\b\d+(?:\.\d+)?\s*wt\s*%\b"
CAPTION = r"(?iU)^\s*(figure|fig\.?|table|scheme)\b"
TRANSITIONS = (
    r"prepared\s+from", r"derived\s+from", r"converted\s+to", r"after\s+(thermal\s+)?imidization",
    r"after\s+freeze[-\s]?drying", r"freeze[-\s]?dried", r"3d\s+printed", r"direct\s+ink\s+writing",
    r"after\s+printing", r"printed\s+.*?(aerogel|film|membrane|foam|fiber|coating)",
)

# Words that mark a modified variant, and tails that turn a hit into one.
VARIANT_MARKERS = {
    "prop": (
        r"\b[A-Z][A-Za-z0-9+-]*\s*/\s*[A-Z][A-Za-z0-9+-]*\b", r"\bcomposite\b", r"\bdoped\b", r"\bloaded\b",
        r"\bfilled\b", r"\breinforced\b", r"\bblend\b", r"\bnanocomposite\b", r"\bnanoparticle", r"\bhybrid\b",
        r"\bwith\b.+\b(nano\w*|particle\w*|fiber\w*|filler\w*|tube\w*|sheet\w*|flake\w*|wire\w*)\b",
    ),
    "proc": (
        r"\bcomposite\b", r"\bdoped\b", r"\bloaded\b", r"\bfilled\b", r"\breinforced\b", r"\bhybrid\b",
        r"\bnanocomposite\b", r"\bnanoparticle", r"\bparticle", r"\bfiber\b", r"\bfibre\b", r"\bfiller\b",
        r"\bdecorated\b",
    ),
}
VARIANT_TAIL = {
    "prop": r"\s*[-,/()]*(?:doped|loaded|filled|reinforced|blend|blended|composite|nanocomposite|hybrid|with)\b",
    "proc": r"\s*[-,/()]*(?:doped|loaded|filled|reinforced|composite|nanocomposite|hybrid|with|decorated)\b",
}

# Shapes of titles inside a process section.
SEGMENT_HEADING = r"(?sU)^\s*#{1,6}\s*(.+?)\s*\z"
SEGMENT_PSEUDO = r"(?U)^\s*[A-Z0-9][A-Za-z0-9\-\s/(),%μ\.]{2,80}\.\s*\z"
SEGMENT_INLINE = r"(?sU)^\s*([A-Z][A-Za-z0-9\-\s/(),%μ]{2,80})\.\s+\S.+\z"
IMAGE_LINE = r"^\s*!\["
