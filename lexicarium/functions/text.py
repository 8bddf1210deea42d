"""Scalar text functions as columns, and Unicode normalisation as an Arrow function (the one form Spark lacks)."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: CJK punctuation and its ASCII form.
CJK_PUNCTUATION = "，。！？；：（）【】“”‘’、"
ASCII_PUNCTUATION = ",.!?;:()[]\"\"'',"


def _variant(c: Column) -> list[tuple[str, Column]]:
    """The steps of a variant after NFKC, each with the text it gives."""
    steps = [("strip", F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))]
    steps.append(("collapse_whitespace", F.regexp_replace(steps[-1][1], r"(?U)\s+", " ")))
    steps.append(("normalize_punctuation", F.replace(F.translate(steps[-1][1], CJK_PUNCTUATION, ASCII_PUNCTUATION), F.lit("…"), F.lit("..."))))
    steps.append(("collapse_punctuation", F.regexp_replace(steps[-1][1], r"([!?.,;:])\1+", "$1")))
    return [*steps, ("lower", F.lower(steps[-1][1]))]


def normalise_variant(c: Column, nfkc: bool = True) -> Column:
    """NFKC, trimmed, white space collapsed, CJK punctuation mapped, repeated marks collapsed, lower case."""
    return _variant(unicode_normal("NFKC")(c) if nfkc else c)[-1][1]


def variant_steps(c: Column) -> Column:
    """The steps that change the text, in order; normalize_punctuation always."""
    composed = unicode_normal("NFKC")(c)
    texts = [("", c), ("nfkc", composed), *_variant(composed)]
    return F.array_compact(F.array(*[F.when(F.lit(name == "normalize_punctuation") | (text != before), name) for (_, before), (name, text) in zip(texts, texts[1:])]))


def variant_group():
    """A pandas UDF: vgrp_ and the BLAKE2b-128 of a variant and the rules' version (a hash that Spark has not)."""

    @F.pandas_udf("string")
    def group(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else "vgrp_" + hashlib.blake2b(f"{v}\nv0003".encode(), digest_size=16).hexdigest())

    return group


def casefolded():
    """A pandas UDF: Unicode case folding."""

    @F.pandas_udf("string")
    def fold(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else v.casefold())

    return fold


def node_of_path(path: Column) -> Column:
    """The node id of a path below /conversation/mapping, null elsewhere."""
    return F.nullif(F.regexp_extract(path, r"^/conversation/mapping/([^/]+)", 1), F.lit(""))


def path_suffix(path: Column) -> Column:
    return F.regexp_replace(path, r"^/conversation/mapping/[^/]+", "")


def dynamic_key(key: Column) -> Column:
    """A key that is an identifier (a UUID) stands as ** in path patterns."""
    return F.when(F.lower(key).rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"), "**").otherwise(key)


def escaped_pointer(key: Column) -> Column:
    """A key as a part of a JSON pointer."""
    return F.replace(F.replace(key, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def safe_name(c: Column) -> Column:
    """A file name: other characters than letters, digits, dot, dash and underscore become underscores."""
    return F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_")


def unicode_normal(form: str):
    """A pandas UDF for NFC, NFD, NFKC or NFKD."""

    @F.pandas_udf("string")
    def normal(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else unicodedata.normalize(form, v))

    return normal


def canonical(c: Column) -> Column:
    """Line endings unified, NFKC, trimmed, white space collapsed, lower case."""
    c = unicode_normal("NFKC")(F.regexp_replace(c, "\r\n?", "\n"))
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " "))


@dataclass(frozen=True)
class CanonicalRules:
    """What makes texts one concept: steps in the order of the fields."""

    line_endings: bool = True
    form: str = "NFC"
    trim: bool = True
    collapse: bool = True
    casefold: bool = False
    fullwidth: bool = False

    def __post_init__(self):
        if self.form not in ("NFC", "NFD", "NFKC", "NFKD"):
            raise ValueError(f"unknown Unicode form {self.form}")

    def apply(self, text: str) -> str:
        if self.line_endings:
            text = text.replace("\r\n", "\n").replace("\r", "\n")
        text = unicodedata.normalize(self.form, text)
        if self.trim:
            text = text.strip()
        if self.collapse:
            text = re.sub(r"\s+", " ", text)
        if self.casefold:
            text = text.casefold()
        return unicodedata.normalize("NFKC", text) if self.fullwidth else text


def canonicaliser(rules: CanonicalRules = CanonicalRules()):
    """A pandas UDF for the canonical form of texts; nulls stay."""

    @F.pandas_udf("string")
    def canonical_form(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else rules.apply(v))

    return canonical_form


def quality_flags(c: Column) -> Column:
    """Array of problems: empty, control characters, replacement characters."""
    return F.array_compact(F.array(F.when(F.trim(c) == "", "empty"), F.when(c.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]"), "control_noise"), F.when(c.contains("�"), "replacement_character")))


def located(c: Column, start: Column, end: Column) -> Column:
    """The characters from start (0-based) to end; null when the bounds are not inside the text."""
    return F.when((start >= 0) & (end >= start) & (end <= F.length(c)), F.substr(c, (start + 1).cast("int"), (end - start).cast("int")))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 1 when both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)
