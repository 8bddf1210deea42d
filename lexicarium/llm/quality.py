"""Quality rules by tokeniser fertility (operator 6).

``apply_quality(docs, model_path, ranks_path)`` keeps every column of ``docs`` and appends the word
counts, the fertility measures of two public vocabularies (a 32k vocabulary with byte fallback and a
byte-level one: characters per token, share of byte tokens, token entropy) and the verdicts
``base_failed``, ``kept`` and ``rejected_by``. Input columns that clash with an appended name (in any
case) are replaced.

Words are runs of ``[^\\x20\\x09-\\x0D]``. ``base_failed``: fewer than 50 words, or over half of
the words lie in a three-word window that the text holds twice or more. A text that passes is kept
when every measure lies inside the band of its language, or of its main script where ``lang`` is
missing. The bands are fitted to the table in one aggregation over all texts that pass the base rule:
quartiles of each measure a group, widened by ``FENCE`` interquartile ranges on the sides that tell
junk from prose (``MEASURES``), and for shares by ``NOISE`` standard errors of a share among that
many tokens. Quartiles are drawn towards ``PRIOR`` with the weight of ``PRIOR_TEXTS`` texts, so small groups
and tables are judged by the same formula as large ones. Entropy is the mean over consecutive
windows of ``WINDOW`` tokens of a window's entropy by its greatest possible one: it does not depend on the text's length.

Defined results: null and empty texts have no words, fail the base rule and are not kept; an
empty table gives an empty table; repeated rows are judged each for itself; a null, blank or unknown
``lang`` takes its script's band. Whole texts are read, whatever their length: long ones are
tokenised in pieces, so a task holds one text and one batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from public_tokenizers import PATTERN
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexicarium.llm.bpe import _encoding, encode_text, rank_bytes
from lexicarium.llm.store import written

MIN_WORDS = 50
REPEAT_PERCENT = 50
PIECE_CHARS = 20_000
WINDOW = 64
FENCE = 4.0
NOISE = 4.0
PRIOR_TEXTS = 50
#: Narrowest interquartile range, as a share of the median: groups of copies do not shrink a band to a point.
LEAST_SPREAD = 0.005
#: Bands (some hundred bytes a group) are broadcast up to this many, else both sides are shuffled.
BROADCAST_ROWS = 100_000

#: Measure, whether too low and too high values reject, and the column of its token count where it is a share.
MEASURES = (
    ("chars_per_token", True, True, None),
    ("byte_fallback_share", False, True, "n_pieces"),
    ("token_entropy", True, False, None),
    ("chars_per_rank", True, True, None),
    ("single_byte_share", False, True, "n_ranks"),
    ("rank_entropy", True, False, None),
)
#: Lower and upper quartile of each measure that stand for PRIOR_TEXTS texts of a script.
PRIOR = {
    "Latin": ((2.6, 4.0), (0.0, 0.02), (0.87, 0.89), (2.6, 4.0), (0.05, 0.14), (0.87, 0.89)),
    "Cyrillic": ((1.7, 2.6), (0.0, 0.06), (0.86, 0.89), (1.8, 3.0), (0.1, 0.3), (0.85, 0.89)),
    "Greek": ((0.9, 1.5), (0.02, 0.3), (0.84, 0.89), (1.0, 1.8), (0.1, 0.4), (0.84, 0.89)),
    "Han": ((0.6, 1.1), (0.1, 0.5), (0.84, 0.9), (0.5, 1.1), (0.2, 0.6), (0.8, 0.9)),
    "Kana": ((0.7, 1.2), (0.05, 0.4), (0.82, 0.89), (0.6, 1.2), (0.2, 0.6), (0.8, 0.89)),
    "Hangul": ((0.4, 1.0), (0.2, 0.8), (0.8, 0.89), (0.5, 1.0), (0.2, 0.7), (0.8, 0.89)),
    "other": ((0.5, 2.5), (0.1, 0.8), (0.78, 0.89), (0.5, 2.5), (0.2, 0.8), (0.78, 0.89)),
}

#: First and last code point of each script's main blocks.
SCRIPT_RANGES = (
    ("Latin", 0x41, 0x5A), ("Latin", 0x61, 0x7A), ("Latin", 0xC0, 0x24F), ("Latin", 0x1E00, 0x1EFF),
    ("Greek", 0x370, 0x3FF), ("Cyrillic", 0x400, 0x52F), ("Han", 0x3400, 0x4DBF), ("Han", 0x4E00, 0x9FFF),
    ("Kana", 0x3040, 0x30FF), ("Hangul", 0x1100, 0x11FF), ("Hangul", 0xAC00, 0xD7A3),
)

_SYMBOLS = re.compile(r"[#*$%&|<>]")

COUNTED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("script", T.StringType()),
        T.StructField("n_pieces", T.LongType()),
        T.StructField("chars_per_token", T.DoubleType()),
        T.StructField("byte_fallback_share", T.DoubleType()),
        T.StructField("token_entropy", T.DoubleType()),
        T.StructField("n_ranks", T.LongType()),
        T.StructField("chars_per_rank", T.DoubleType()),
        T.StructField("single_byte_share", T.DoubleType()),
        T.StructField("rank_entropy", T.DoubleType()),
    ]
)


@lru_cache(maxsize=1)
def _processor(model: bytes) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray]:
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    return sp, np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])


@lru_cache(maxsize=1)
def _ranks(ranks: bytes):
    enc = _encoding(ranks, PATTERN)
    single = np.zeros(enc.n_vocab, bool)
    for b in range(256):
        single[enc.encode_single_token(bytes([b]))] = True
    return enc, single


def main_script(text: str) -> str:
    """The script with most letters among SCRIPT_RANGES ("other" without any), ties by table order."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    counts: dict[str, int] = {}
    for name, low, high in SCRIPT_RANGES:
        counts[name] = counts.get(name, 0) + int(((points >= low) & (points <= high)).sum())
    best = max(counts, key=counts.get)
    return best if counts[best] else "other"


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice in the text, the first one included."""
    n = len(words) - 2
    if n < 2:
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == n:
        return 0
    index: dict[tuple, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in windows), np.int64, n)
    repeated = np.bincount(ids)[ids] > 1
    covered = np.zeros(n + 2, bool)
    for shift in range(3):
        covered[shift : shift + n] |= repeated
    return int(covered.sum())


def base_counts(raw: bytes, text: str) -> tuple[int, int, int, int, int, bool]:
    words = raw.split()  # bytes.split() parts at exactly \x20 and \x09-\x0D
    chars = sum(len(w.decode("utf-8", "replace")) for w in words) if len(raw) != len(text) else sum(map(len, words))
    lines = [x for x in raw.split(b"\n") if x.split()]
    repeats = repeat_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * len(words)
    return len(words), chars, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeats, failed


def _pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a long text before a space, which starts a piece of the vocabulary anyway (the vocabulary puts one before every text)."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        if cut < 0 or cut + 1 == len(text):
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def piece_ids(sp, text: str, size: int = PIECE_CHARS) -> list[int]:
    return sp.encode(text) if len(text) <= size else [i for piece in _pieces(text, size) for i in sp.encode(piece)]


def fertility(texts: list[str], ids: list[list[int]], is_byte: np.ndarray) -> list[tuple[int, float, float, float]]:
    """(tokens, characters per token, share of byte tokens, windowed entropy share) of each text; zeros without tokens."""
    n = np.array([len(x) for x in ids], np.int64)
    flat = np.fromiter((i for x in ids for i in x), np.int64, int(n.sum()))
    owner = np.repeat(np.arange(len(n)), n)
    windows = np.maximum(1, n // WINDOW)  # the last window takes what is left
    at = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    first = np.cumsum(windows) - windows
    window = np.repeat(first, n) + np.minimum(at // WINDOW, np.repeat(windows, n) - 1)
    size = np.bincount(window, minlength=int(windows.sum()))
    keys = np.sort(window * len(is_byte) + flat)
    edge = np.flatnonzero(np.diff(keys, prepend=-1))
    run = np.diff(np.append(edge, len(keys)))
    used = np.bincount(keys[edge] // len(is_byte), weights=run * np.log2(run), minlength=len(size))
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(size > 1, 1 - used / (size * np.log2(size)), 0.0)
    entropy = np.add.reduceat(share, first) / windows if len(n) else share
    with np.errstate(divide="ignore", invalid="ignore"):
        chars = np.where(n > 0, np.array([len(t) for t in texts]) / n, 0.0)
        in_bytes = np.where(n > 0, np.bincount(owner, weights=is_byte[flat], minlength=len(n)) / n, 0.0)
    return list(zip(n.tolist(), chars.tolist(), in_bytes.tolist(), entropy.tolist(), strict=True))


def _measure(batches: Iterable[pa.RecordBatch], model, ranks) -> Iterator[pa.RecordBatch]:
    sp, is_byte = _processor(model.value)
    enc, single = _ranks(ranks.value)
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            raws = [x or b"" for x in part.column(part.num_columns - 1).to_pylist()]
            texts = [raw.decode("utf-8", "replace") for raw in raws]
            base = [base_counts(raw, text) for raw, text in zip(raws, texts, strict=True)]
            by_piece = fertility(texts, [piece_ids(sp, t) for t in texts], is_byte)
            by_rank = fertility(texts, [encode_text(enc, t) for t in texts], single)
            rows = [(*b, main_script(t), *p, *r) for b, t, p, r in zip(base, texts, by_piece, by_rank, strict=True)]
            columns = [pa.array(c) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.null())] * len(COUNTED)
            names = [f"c{i}" for i in range(part.num_columns - 1)] + COUNTED.names
            yield pa.RecordBatch.from_arrays(part.columns[:-1] + columns, names=names)


def measured(docs: DataFrame, model_path: str, ranks_path: str, text_col: str = "text", lang_col: str = "lang", without_text: bool = False) -> DataFrame:
    """docs with ``band_group`` and the columns of COUNTED, as a table of the shared folder; ``without_text`` leaves the text out of it."""
    context = docs.sparkSession.sparkContext
    model, ranks = context.broadcast(rank_bytes(model_path)), context.broadcast(rank_bytes(ranks_path))
    taken = {n.lower() for n in [*COUNTED.names, "kept", "rejected_by", "band_group"]}
    keep = [c for c in docs.columns if c.lower() not in taken and not (without_text and c == text_col)]
    lang = F.nullif(F.trim(F.col(f"`{lang_col}`").cast("string")), F.lit("")) if lang_col in docs.columns else F.lit(None).cast("string")
    # positional names inside the task: clashing or odd column names of the input cannot matter
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], lang.alias("band_group"), F.col(f"`{text_col}`").cast("binary").alias("raw"))
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(inner.schema.fields[:-1])] + COUNTED.fields)
    out = inner.mapInArrow(lambda it: _measure(it, model, ranks), schema)
    table = written(out.withColumn("band_group", F.coalesce(F.col(f"c{len(keep)}"), F.col("script"))).drop(f"c{len(keep)}"), "measured")
    return table.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "band_group", *COUNTED.names)


def bands(table: DataFrame) -> DataFrame:
    """(band_group, n_texts, <measure>_low, <measure>_high, <measure>_middle) fitted to the texts that pass the base rule; a side that does not reject is null."""
    names = [m[0] for m in MEASURES]
    good = table.where("not base_failed")
    fitted = good.groupBy("band_group").agg(F.count(F.lit(1)).alias("n_texts"), F.mode("script", True).alias("prior_script"), *[F.percentile_approx(m, [0.25, 0.5, 0.75], 10_000).alias(m) for m in names])
    out = [F.col("band_group"), F.col("n_texts")]
    for k, (name, low, high, _) in enumerate(MEASURES):
        prior = F.create_map(*[x for s, p in PRIOR.items() for x in (F.lit(s), F.array(F.lit(p[k][0]), F.lit(sum(p[k]) / 2), F.lit(p[k][1])))])[F.col("prior_script")]
        drawn = lambda i: (F.col("n_texts") * F.col(name)[i] + PRIOR_TEXTS * prior[i]) / (F.col("n_texts") + PRIOR_TEXTS)  # noqa: B023, E731
        spread = F.greatest(drawn(2) - drawn(0), LEAST_SPREAD * drawn(1))
        out += [(drawn(0) - FENCE * spread if low else F.lit(None).cast("double")).alias(f"{name}_low"), (drawn(2) + FENCE * spread if high else F.lit(None).cast("double")).alias(f"{name}_high"), drawn(1).alias(f"{name}_middle")]
    return fitted.select(*out)


def judged(table: DataFrame, fitted: DataFrame) -> DataFrame:
    """table with ``kept`` and ``rejected_by``, the measures outside their bands (empty where the base rule fails)."""
    edges = [c for c in fitted.columns if c not in ("band_group", "n_texts")]
    side = fitted.select(F.col("band_group").alias("fitted_group_"), F.struct(*edges).alias("band_"))
    side = F.broadcast(side) if side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else side
    joined = table.join(side, F.col("band_group") == F.col("fitted_group_"), "left")

    def outside(name: str, low: bool, high: bool, tokens: str | None) -> Column:
        middle = F.col(f"band_.{name}_middle")
        slack = NOISE * F.sqrt(middle * (1 - middle) / F.greatest(F.col(tokens), F.lit(1))) if tokens else F.lit(0.0)
        test = F.lit(False)
        if low:
            test = test | (F.col(name) < F.col(f"band_.{name}_low") - slack)
        if high:
            test = test | (F.col(name) > F.col(f"band_.{name}_high") + slack)
        return F.when(~F.col("base_failed") & test, F.lit(name))

    found = F.array_compact(F.array(*[outside(*m) for m in MEASURES]))
    return joined.withColumn("rejected_by", found).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("fitted_group_", "band_")


OUTPUT = [*COUNTED.names[:6], "kept", "rejected_by", *COUNTED.names[6:]]


def apply_quality(docs: DataFrame, model_path: str, ranks_path: str, text_col: str = "text", lang_col: str = "lang", without_text: bool = False) -> DataFrame:
    """Append counts, fertility and verdicts to every row; one pass over the texts, which meet no shuffle. Both paths: vocabularies of bounded size."""
    table = measured(docs, model_path, ranks_path, text_col, lang_col, without_text)
    own = [c for c in table.columns if c not in (*COUNTED.names, "band_group")]
    return judged(table, bands(table)).select(*[F.col(f"`{c}`") for c in own], *OUTPUT)


def keep_good(docs: DataFrame, model_path: str, ranks_path: str, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs that the rules keep, with docs' own columns only."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"), (F.col(f"`{lang_col}`") if lang_col in docs.columns else F.lit(None)).cast("string").alias("lang"))
    kept = apply_quality(row, model_path, ranks_path, without_text=True).where("kept")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
