"""Incremental secret scan over content-addressed blobs, in DataFrame operations only.

Every version of every file is named by the SHA-256 of its text.  The *ledger* holds, per (blob, rule version), the spans
found.  A scan takes the pairs that the ledger does not hold, scans each such text once, however many paths and versions
share it, and joins the spans back to all paths.  Rules that change get a new version, so only they run again.

A rule is a pattern, the group whose length counts, the least length, and a cheaper pattern that every hit contains.
Matches are leftmost and do not overlap within a rule; those that are too short are dropped after matching, so they still
use up their text.  Positions come from the lengths of the pieces between matches, in code points.

A null text is an empty one; an empty text has no spans but is recorded as scanned; repeated rows are paths of their own;
spans that start at the same place are ordered by the rule's place in the list; an empty table gives no rows; further
columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import parked


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int
    least: int
    hint: str


_KEYWORD = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
).replace("_[?]", "_?")
_ASSIGN = f"({_KEYWORD})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]"

#: Base rules first; their order is the order of kinds at one start.
BASE = (
    Rule("assign", _ASSIGN + "+)", 2, 12, _ASSIGN + "{12})"),
    Rule("access", "AKIA[A-Z0-9]{14,}", 0, 18, "AKIA[A-Z0-9]{14}"),
    Rule("hex", "[0-9a-f]{16,}", 0, 16, "[0-9a-f]{16}"),
)
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, "PRIVATE KEY-----"),
    Rule("code_host", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, "gh[pousr]_"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, "xox[abprs]-"),
    Rule("signed_token", "eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{5,}", 0, 30, "eyJ[A-Za-z0-9_-]{10}"),
    Rule("url_login", "[a-z]{3,12}://[A-Za-z0-9_.-]{1,64}:[^\\s:/@]{3,64}@", 0, 1, "://"),
)
RULES = BASE + MORE
VERSION = "1"

LEDGER = (
    "blob string, rules string, spans array<struct<start: bigint, place: int, kind: string, end: bigint>>"
)


def _matches(text: Column, place: int, rule: Rule) -> Column:
    """Array of (place, gap, width, good) for one rule: the length before each match, its length, whether it counts."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    gaps = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(whole))
    zipped = F.transform(
        F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), counted.alias("counted")),
        lambda x: F.struct(
            F.lit(place).alias("place"),
            F.length(x["gap"]).alias("gap"),
            F.length(x["whole"]).alias("width"),
            (F.length(x["counted"]) >= rule.least).alias("good"),
        ),
    )
    return F.when(text.rlike(rule.hint), zipped)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, version: str = VERSION) -> DataFrame:
    """Ledger rows of (blob, text) rows, one per blob."""
    parts = [_matches(F.col("text"), i, r) for i, r in enumerate(rules)]
    found = F.flatten(F.array(*[F.coalesce(p, F.expr("cast(array() as array<struct<place: int, gap: int, width: int, good: boolean>>)")) for p in parts]))
    hits = blobs.select("blob", F.posexplode_outer(found).alias("i", "hit")).select("blob", "i", "hit.*")
    run = Window.partitionBy("blob", "place").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = hits.withColumn("end", F.sum((F.col("gap") + F.col("width")).cast("long")).over(run))
    kinds = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("place") + 1)
    span = F.when(
        F.col("good"),
        F.struct(
            (F.col("end") - F.col("width")).alias("start"), "place", F.when(F.col("place") >= 0, kinds).alias("kind"), "end"
        ),
    )
    return hits.groupBy("blob").agg(F.lit(version).alias("rules"), F.array_sort(F.collect_list(span)).alias("spans"))


def blob_of(text: Column) -> Column:
    """The content address of a text."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan(
    versions: DataFrame,
    path: str = "path",
    text: str = "text",
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    version: str = VERSION,
) -> tuple[DataFrame, DataFrame]:
    """((path, blob, spans) of every row of ``versions``, the ledger rows that this scan adds)."""
    content = F.coalesce(F.col(text), F.lit("")).alias("text")
    named = versions.select(F.col(path).alias("path"), blob_of(F.col(text)).alias("blob"), content)
    unseen = named.select("blob", "text")
    if ledger is not None:
        known = ledger.where(F.col("rules") == version)
        unseen = unseen.join(known.select("blob"), "blob", "left_anti")
    new = parked(scan_blobs(unseen.groupBy("blob").agg(F.first("text").alias("text")), rules, version), "ledger")
    entries = new if ledger is None else new.unionByName(known)
    return named.select("path", "blob").join(entries.select("blob", "spans"), "blob", "left").select("path", "blob", "spans"), new


def digest(spans: Column, base_only: bool) -> Column:
    """kind:start:end of the spans, comma-joined."""
    if base_only:
        spans = F.filter(spans, lambda s: s["place"] < len(BASE))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every stretch that spans cover replaced by one mark; spans are in order of their starts."""
    zero = F.expr("named_struct('upto', bigint(0), 'parts', cast(array() as array<string>))")
    piece = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))

    def step(done, s):
        apart = F.when(s["start"] >= done["upto"], F.array(piece(done["upto"], s["start"]), F.lit(mark))).otherwise(
            F.expr("cast(array() as array<string>)")
        )
        return F.struct(F.greatest(done["upto"], s["end"]).alias("upto"), F.concat(done["parts"], apart).alias("parts"))

    return F.when(F.size(spans) <= 0, text).otherwise(
        F.aggregate(
            spans,
            zero,
            step,
            lambda done: F.concat(F.array_join(done["parts"], ""), F.substring(text, (done["upto"] + 1).cast("int"), F.length(text))),
        )
    )
