"""Decision statuses of inventory rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Statuses, and the words of older files that stand for them.
FINAL = ("chosen", "excluded")
PENDING = "needs_manual"
OLD_CHOSEN = ("selected",)
OLD_PENDING = ("manual_required", "ambiguous")
OLD_EXCLUDED = ("unresolved", "rejected")

# Lexicographer files of senses that name something to be seen, and of senses that may do so.
OBJECT_LEXFILES = ("noun.animal", "noun.artifact", "noun.body", "noun.food", "noun.object", "noun.person", "noun.plant", "noun.substance")
CONDITIONAL_OBJECT_LEXFILES = ("noun.communication", "noun.group", "noun.location", "noun.phenomenon", "noun.possession", "noun.shape", "noun.Tops")
# The same for attributes.
ATTRIBUTE_LEXFILES = ("adj.all", "adj.pert", "adj.ppl", "noun.attribute", "noun.shape", "noun.state", "noun.substance")
CONDITIONAL_ATTRIBUTE_LEXFILES = (
    "noun.Tops", "noun.act", "noun.animal", "noun.artifact", "noun.body", "noun.cognition", "noun.communication", "noun.event", "noun.food", "noun.group",
    "noun.location", "noun.object", "noun.person", "noun.phenomenon", "noun.plant", "noun.possession", "noun.process", "noun.quantity", "noun.relation",
    "noun.time", "verb.body", "verb.change", "verb.cognition", "verb.communication", "verb.competition", "verb.consumption", "verb.contact", "verb.creation",
    "verb.emotion", "verb.motion", "verb.perception", "verb.possession", "verb.social", "verb.stative", "verb.weather",
)


def _blank(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit("")))


def legacy_status(value: Column) -> Column:
    """chosen, excluded, needs_manual or, for no value, ''; unknown words need a decision."""
    return (
        F.when(value.isin(*FINAL, PENDING), value)
        .when(value.isin(*OLD_CHOSEN), "chosen")
        .when(value.isin(*OLD_PENDING), PENDING)
        .when(value.isin(*OLD_EXCLUDED), "excluded")
        .when(value != "", PENDING)
        .otherwise("")
    )


def decision_status(explicit: Column, extraction: Column, selection: Column) -> Column:
    """The explicit status, else the older columns'. An explicit word that is not a status needs a decision."""
    explicit, extraction, selection = map(_blank, (explicit, extraction, selection))
    stated = F.when(explicit.isin(*FINAL, PENDING), explicit).when(explicit.isin(*OLD_CHOSEN), "chosen").otherwise(PENDING)
    return F.when(explicit != "", stated).otherwise(legacy_status(F.when(extraction != "", extraction).otherwise(selection)))


class Kind:
    """What differs between objects and attributes when a sense is judged."""

    def __init__(self, name: str, compatible: tuple[str, ...], conditional: tuple[str, ...], without_sense: str, none_reason: str, manual_reason: str):
        self.name, self.compatible, self.conditional = name, compatible, conditional
        self.without_sense, self.none_reason, self.manual_reason = without_sense, none_reason, manual_reason


# What a decision is called where no sense is found, and where one must be made by hand.
OBJECT = Kind("object", OBJECT_LEXFILES, CONDITIONAL_OBJECT_LEXFILES, "excluded", "no_oewn_noun_synset", "manual_objectness_required")
ATTRIBUTE = Kind("attribute", ATTRIBUTE_LEXFILES, CONDITIONAL_ATTRIBUTE_LEXFILES, "chosen", "no_oewn_attribute_synset", "manual_attribute_gate_required")


def gate(lexfile: Column, kind: Kind = OBJECT) -> Column:
    """compatible, conditional or in hard conflict by the lexicographer file; '' without one."""
    lexfile = F.coalesce(lexfile, F.lit(""))
    return F.when(lexfile.isin(*kind.compatible), f"{kind.name}_compatible").when(lexfile.isin(*kind.conditional), "conditional").when(lexfile != "", "hard_conflict").otherwise("")


def selection_status(selected: Column, n_synsets: Column, gate_: Column, kind: Kind = OBJECT) -> Column:
    """chosen for a compatible sense; several senses without a choice, and doubtful senses, need a decision."""
    none = F.coalesce(selected, F.lit("")) == ""
    return F.when(none & (n_synsets > 0), PENDING).when(none, kind.without_sense).when(gate_ == f"{kind.name}_compatible", "chosen").otherwise(PENDING)


def selection_reason(selected: Column, n_synsets: Column, gate_: Column, kind: Kind = OBJECT) -> Column:
    none = F.coalesce(selected, F.lit("")) == ""
    return F.when(none & (n_synsets > 0), "manual_synset_required").when(none, kind.none_reason).when(gate_ == f"{kind.name}_compatible", f"selected_{kind.name}_compatible").otherwise(kind.manual_reason)
