"""Secret scan: candidates by pattern, judged by who owns their values.

``find_candidates`` scans each whole text (Arrow batches). Candidates are
either of the base kinds, which are always reported, or ``opaque``: long
mixed strings that nothing but their ownership can tell from a checksum or
a sample value. ``ownership`` aggregates the hashes of all candidate values
over the corpus by distinct repositories and owners. A value that many owners
or very many repositories hold is a copied example; a value of few is taken
for a live credential. Opaque candidates are reported only if live.

Values leave a scan task only as SHA-256 digests. Hot values are combined
before the shuffle, and the verdict join is a plain equi join that adaptive
execution may split.

Defined results
  * NULL text counts as empty: no spans. Every input row gives one output
    row; repeated rows count as one repository if their ids are equal.
  * NULL repository or owner counts as one unknown repository or owner.
  * Spans are in code points, end exclusive, sorted by start, then kind.
  * An empty table gives an empty result. Names of the caller's further
    columns are kept apart, as only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

KINDS = ("assign", "access", "hex", "opaque")
# Fixed patterns of the base kinds, with the least length that counts.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_CHARS, ACCESS_CHARS = 8, 16
# The further kind: one unbroken run with letters and digits in it, far from an even pattern.
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
OPAQUE_DIGITS, OPAQUE_BITS = 3, 3.3
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 50  # as many or more: a copied example


def _bits(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def scan(text: str) -> list[tuple[str, int, int, str]]:
    """``(kind, start, end, value)`` by start, then kind."""
    out = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= ASSIGN_CHARS:
            out.append(("assign", m.start(), m.end(), m[2]))
    for m in ACCESS.finditer(text):
        if len(m[0]) >= ACCESS_CHARS:
            out.append(("access", m.start(), m.end(), m[0]))
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    base = sorted((a, b) for _, a, b, _ in out)
    starts, ends = [a for a, _ in base], [0, *accumulate((b for _, b in base), max)]  # how far the first spans reach
    for m in OPAQUE.finditer(text):
        s = m[0]
        if (sum(c.isdigit() for c in s) >= OPAQUE_DIGITS and any(c.isalpha() for c in s) and _bits(s) >= OPAQUE_BITS
                and ends[bisect_left(starts, m.end())] <= m.start()):
            out.append(("opaque", m.start(), m.end(), s))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


FOUND = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType()), T.StructField("value", T.StringType())]))


@F.pandas_udf(FOUND)
def _find(texts: pd.Series) -> pd.Series:
    return texts.fillna("").map(lambda t: [
        {"kind": k, "start": a, "end": b, "value": hashlib.sha256(v.encode()).hexdigest()} for k, a, b, v in scan(t)])


def find_candidates(text: Column) -> Column:
    return _find(text)


def ownership(found: DataFrame) -> DataFrame:
    """``value, n_repositories, n_owners`` from ``_found, _repository, _owner``."""
    held = found.select(F.explode("_found.value").alias("value"), F.coalesce("_repository", F.lit("")).alias("r"),
                        F.coalesce("_owner", F.lit("")).alias("o")).distinct()
    held = held.groupBy("value", "o").agg(F.count(F.lit(1)).alias("n"))  # a repository has one owner
    return held.groupBy("value").agg(F.sum("n").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners"))


def scan_secrets(df: DataFrame, doc: str = "doc_id", text: str = "text", repository: str = "doc_id",
                 owner: str = "source", example_owners: int = EXAMPLE_OWNERS,
                 example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """One row per input row: ``doc_id`` and ``spans``, an array of ``start,
    rank, kind, end, example`` (rank: place of the kind in ``KINDS``)."""
    found = materialize(df.select(
        F.monotonically_increasing_id().alias("_row"), F.col(doc).alias("doc_id"),
        F.col(repository).cast("string").alias("_repository"), F.col(owner).cast("string").alias("_owner"),
        find_candidates(F.col(text)).alias("_found")), "secret-candidates")
    copied = ownership(found).where((F.col("n_owners") >= example_owners) | (F.col("n_repositories") >= example_repositories))
    spans = found.select("_row", F.explode("_found").alias("f")).select("_row", "f.*")
    spans = spans.join(copied.select("value", F.lit(True).alias("example")), "value", "left").na.fill(False, ["example"])
    spans = spans.where(~F.col("example") | (F.col("kind") != "opaque"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = spans.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
        "start", rank.alias("rank"), "kind", "end", "example"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,rank:bigint,kind:string,end:bigint,example:boolean>>")
    return found.select("_row", "doc_id").join(spans, "_row", "left").select(
        "doc_id", F.coalesce("spans", none).alias("spans"))
