"""Secret scan with corpus-wide ownership frequency.

Candidates are found by pattern in every whole text. Their values, hashed, are counted over the corpus by distinct repository
and owner: a value that several owners carry is a widely copied example, one that stays with a single owner and looks random is
taken for a live credential.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborlog.llm.common import columns, written

# The kinds in the order of the joined text, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
LIVE_KIND = "live"

_assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
# A greedy run that is too short holds no longer one, so the least length may stand in the pattern.
_access = re.compile(rf"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}")
_hex = re.compile(rf"[0-9a-f]{{{MIN_HEX},}}")

SPAN = T.StructType(
    [T.StructField("kind", T.StringType())]
    + [T.StructField(name, T.IntegerType()) for name in ("start", "end", "value_start", "value_end")]
    + [T.StructField("value_hash", T.StringType()), T.StructField("entropy", T.DoubleType())]
)


def _entropy(value: str) -> float:
    """Bits per character."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def find_spans(text: str | None) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, value start, value end) in code points, by start, then kind.

    Per kind the leftmost matches that do not overlap; a match below the least length is dropped after it was matched, so
    what it covers is not searched again. Null has none.
    """
    if not text:
        return []
    found = [("assign", *m.span(), *m.span(2)) for m in _assign.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    found += [("access", *m.span(), *m.span()) for m in _access.finditer(text)]
    found += [("hex", *m.span(), *m.span()) for m in _hex.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _described(text: str | None) -> list[dict]:
    out = []
    for kind, start, end, v0, v1 in find_spans(text):
        value = text[v0:v1]
        digest = hashlib.sha256(value.encode()).hexdigest()[:32]
        out.append(dict(kind=kind, start=start, end=end, value_start=v0, value_end=v1, value_hash=digest, entropy=_entropy(value)))
    return out


@F.pandas_udf(T.ArrayType(SPAN))
def _candidates(texts: pd.Series) -> pd.Series:
    return pd.Series([_described(t) for t in texts], dtype=object)


def _scanned(docs: DataFrame, kept: list[str]) -> DataFrame:
    """``docs`` as a written table: _row (a number fixed by writing), _doc (the kept columns), source, _spans."""
    table = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*columns(kept)).alias("_doc"),
        F.coalesce(F.col("source").cast("string"), F.lit("\u0000")).alias("source"),
        _candidates(F.col("text")).alias("_spans"),
    )
    return written(table, "secret-spans")


def ownership(values: DataFrame) -> DataFrame:
    """(source, value_hash) rows to n_repositories (distinct sources) and n_owners per hash.

    The owner is the part of the source before its first ``/``. Counted in two steps, (hash, source) first, which combine
    before the shuffle: a value that a third of the corpus carries is a few rows by then.
    """
    pairs = values.select("source", "value_hash").distinct()
    owners = pairs.groupBy("value_hash", F.substring_index("source", "/", 1).alias("owner")).agg(F.count("*").alias("n"))
    return owners.groupBy("value_hash").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))


def _judged(table: DataFrame, max_owners: int, min_entropy: float) -> DataFrame:
    """Per row that has candidates: _row, found (candidates with verdict, by start, then kind)."""
    spans = table.filter(F.size("_spans") > 0).select("_row", "source", F.explode("_spans").alias("s")).select("_row", "source", "s.*")
    # A left join keeps the candidates' side, so that adaptive execution may split a hot value.
    counted = spans.drop("source").join(ownership(spans), "value_hash", "left")
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    live = (F.col("n_owners") <= max_owners) & (F.col("entropy") >= min_entropy)
    fields = ["start", place.alias("place"), "kind", "end", "value_start", "value_end", "value_hash", "n_repositories", "n_owners", live.alias("live")]
    return counted.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("found"))


def _with_verdicts(docs: DataFrame, kept: list[str], max_owners: int, min_entropy: float) -> DataFrame:
    table = _scanned(docs, kept)
    judged = _judged(table, max_owners, min_entropy)
    empty = F.array().cast(judged.schema["found"].dataType)
    some = table.filter(F.size("_spans") > 0).select("_row", "_doc").join(judged, "_row")
    # Most rows have no candidate and take no part in a shuffle.
    none = table.filter(F.size("_spans") == 0).select("_row", "_doc", empty.alias("found"))
    return some.unionByName(none)


def find_secrets(docs: DataFrame, max_owners: int = 1, min_entropy: float = 3.0) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, spans.

    ``spans`` are all candidates of the whole text, by start, then kind, each with its place, the place of its value, the hash
    of the value, n_repositories, n_owners and ``live``: at most ``max_owners`` owners carry the value and its characters hold
    ``min_entropy`` bits each or more. A null or empty text has none; a null source is one repository with an owner of its own;
    repeated rows are reported each; other columns are not looked at.
    """
    return _with_verdicts(docs, ["doc_id"], max_owners, min_entropy).select("_doc.doc_id", F.col("found").alias("spans"))


@F.pandas_udf(T.StringType())
def _masked(texts: pd.Series, starts: pd.Series, ends: pd.Series, mask: pd.Series) -> pd.Series:
    out = []
    for text, first, last, put in zip(texts, starts, ends, mask):
        end = len(text)
        parts = []
        # From the right; spans may overlap, as a hex value inside an assignment does.
        for a, b in sorted(zip(first, last), reverse=True):
            if b <= end:
                parts += [text[b:end], put]
            end = min(end, a)
        out.append("".join([text[:end], *reversed(parts)]))
    return pd.Series(out, dtype=object)


def redact(docs: DataFrame, mask: str = "[SECRET]", max_owners: int = 1, min_entropy: float = 3.0) -> DataFrame:
    """``docs`` with the values of live credentials replaced by ``mask``, and n_chars renewed where the text changed.

    Every row and every column stays. Widely copied examples and values that do not look random stay as they are.
    """
    rows = _with_verdicts(docs, docs.columns, max_owners, min_entropy)
    live = F.filter("found", lambda s: s["live"])
    rows = rows.select("_doc", F.transform(live, lambda s: s["value_start"]).alias("first"), F.transform(live, lambda s: s["value_end"]).alias("last"))
    kept = rows.filter(F.size("first") == 0).select("_doc.*")
    masked = rows.filter(F.size("first") > 0).select("_doc", _masked("_doc.text", "first", "last", F.lit(mask)).alias("_text"))
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast("bigint")}
    changed = masked.select(*[new.get(c, F.col("_doc").getField(c)).alias(c) for c in docs.columns])
    return kept.unionByName(changed)
