"""Predicates on labels.  Each null dialect has its own name; they differ on purpose and must not be mixed.

All return true or false, never null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels that say nothing.
GENERIC = ("unknown", "other", "unclassified", "unclassified_l4", "n/a", "na", "none")
#: Texts that mean true.
TRUEISH = ("true", "t", "1", "yes", "y")
UNCATEGORIZED = "Uncategorized"
UNCLASSIFIED = "Unclassified"
LEGACY_UNCLASSIFIED = "unclassified_l4"
#: Fixed value: labels that are taken out at the end, matched from the start of the lower-cased label.
INVALID_L4 = r"^(?:(insufficient|unknown|missing|unable_to_classify|pending_details|n/a|none)$|insufficient_|_unknown$|_missing$)"
#: Labels holding one of these words are refused while labelling.
REFUSED_WORDS = ("insufficient", "unknown", "missing", "unable_to_classify", "pending_details", "n/a", "none")


def _sure(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def usable(c: Column, generic: tuple = GENERIC) -> Column:
    return _sure((F.trim(c) != "") & ~F.lower(F.trim(c)).isin(*generic))


def missing(c: Column) -> Column:
    return c.isNull() | _sure(F.lower(F.trim(c)).isin("", "none"))


def missing_in_target(c: Column) -> Column:
    """As the target's own query tests it: ``None`` counts without trimming and in this case only."""
    return c.isNull() | _sure((F.trim(c) == "") | (c == "None"))


def backfill_missing(c: Column) -> Column:
    return c.isNull() | _sure((F.trim(c) == "") | (F.lower(c) == "none"))


def uncategorized(c: Column) -> Column:
    return missing(c) | _sure(F.trim(c) == UNCATEGORIZED)


def nonempty(c: Column) -> Column:
    return _sure((F.trim(c) != "") & (F.lower(F.trim(c)) != "none"))


def filled(c: Column) -> Column:
    """Not null and not blank; ``None`` counts as a value."""
    return _sure(F.trim(c) != "")


def trueish(c: Column) -> Column:
    return _sure(F.lower(F.trim(c.cast("string"))).isin(*TRUEISH))


def norm(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def canonical(c: Column) -> Column:
    """Match key of a label: trimmed, lower case; ``_``, ``-`` and blanks equal; punctuation gone."""
    spaced = F.regexp_replace(F.lower(F.trim(c)), r"[_\- ]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(spaced, r"[^\p{L}\p{N} ]", ""), " +", " "))


def label_path(*levels: Column) -> Column:
    """Usable levels joined by an arrow; null if none is usable."""
    return F.nullif(F.concat_ws(" → ", *(F.when(usable(c), F.trim(c)) for c in levels)), F.lit(""))


def clean_l4(c: Column) -> Column:
    """Final clean-up: the legacy fallback becomes the official one, invalid labels become null."""
    return F.when(F.lower(c) == LEGACY_UNCLASSIFIED, UNCLASSIFIED).when(~_sure(F.lower(c).rlike(INVALID_L4)), c)


def refused_l4(c: Column) -> Column:
    """Refused while labelling: a refused word anywhere, or an unofficial fallback."""
    low = F.lower(F.trim(c))
    word = low.rlike("|".join(REFUSED_WORDS))
    return c.isNull() | _sure(word | (low.contains("unclassif") & (low != UNCLASSIFIED.lower())))


#: Words of a path and the kind of intervention they suggest; the first row that fits wins.
INTERVENTIONS = (
    ("Virtual Agent / Self-Service", ("account lock", "password reset", "unlock", "pin reset")),
    ("L1 Automation Script", ("cache", "reboot", "restart", "power cycle")),
    ("Access Request Automation", ("access denied", "provisioning", "license", "permission", "access - new")),
    ("Infrastructure Configuration Fix", ("citrix", "vpn", "zscaler", "wi-fi", "wifi", "network")),
    ("Knowledge Base Deflection", ("training", "how-to", "guidance", "informational")),
    ("Vendor SLA / Escalation", ("outage", "isp", "vendor", "third-party", "third party")),
)
DEFAULT_INTERVENTION = "Process Redesign"


def intervention_type(path: Column, rules: tuple = INTERVENTIONS, default: str = DEFAULT_INTERVENTION) -> Column:
    low, out = F.lower(F.coalesce(path, F.lit(""))), F.lit(default)
    for name, words in reversed(rules):
        fits = low.contains(words[0])
        for word in words[1:]:
            fits = fits | low.contains(word)
        out = F.when(fits, name).otherwise(out)
    return out
