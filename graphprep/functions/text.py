"""Label and token functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of an indexed substring.
GRAM = 3

# Fixed value: the predicate of label triples.
RDFS_LABEL = "<http://www.w3.org/2000/01/rdf-schema#label>"


def is_english_label(rel: Column, obj: Column, strict: bool = False) -> Column:
    """True for label triples tagged English.

    The usual test accepts ``@en`` anywhere in the literal (so ``@en-GB`` too); ``strict`` wants the tag at the end.
    """
    tagged = obj.rlike('"@en$') if strict else obj.contains("@en")
    return (rel == F.lit(RDFS_LABEL)) & tagged


def extract_label(obj: Column) -> Column:
    """The text between the last two double quotes of a literal."""
    return F.substring_index(F.substring_index(obj, '"', -2), '"', 1)


def tokens(text: Column) -> Column:
    """Lower-cased tokens split on single blanks; a double blank gives an empty token."""
    return F.split(F.lower(text), " ", -1)

