"""Secret scans with multipart credential linking. DataFrame functions only.

Certain findings (an assigned secret, an access identifier, a long hex run) are
reported by themselves. Weak candidates, a 40-character key or an endpoint
address, prove nothing alone: they are reported only when a
complementary part stands within ``reach`` code points, which an interval join
on (document, stretch of text) finds. A key needs an access identifier near it;
an endpoint needs an access identifier or an assigned secret.

A key is 40 of the characters that may stand in one, ``[A-Za-z0-9+/]``, with
none of them after it and none but "/" before it, so a name and "=", "_", "-" or
"/" in front are not taken for a part of it; or a run of exactly 40 that has
"=", "_" or "-" in it as well.

Spans are code points, end exclusive. A pattern's places follow from the
lengths of the stretches between its matches, so one pass of ``split`` and one
of ``regexp_extract_all`` over a text that has a match give all spans.

Null texts count as empty and have no spans. Documents are told apart by id and
text, so null ids and repeated rows get results like others. Texts of any
length are scanned whole. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lucrum.llm.common import stored

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind: (pattern, group that is measured, its least length, its greatest length)
CERTAIN = {"assign": (ASSIGN, 2, 6, None), "access": (r"AKIA[A-Z0-9]+", 0, 20, None), "hex": (r"[0-9a-f]{24,}", 0, 24, None)}
KEY = (r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{40}(?![A-Za-z0-9+/=_-])"
       r"|(?<![A-Za-z0-9+])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])")
WEAK = {"key": (KEY, 0, 40, 40), "endpoint": (r"https?://[A-Za-z0-9.-]+(:[0-9]+)?(/[A-Za-z0-9_./?&=%#-]*)?", 0, 1, None)}
NEEDS = {"key": ("access",), "endpoint": ("access", "assign")}
KINDS = [*CERTAIN, *WEAK]
REACH = 200


def _row_key(id_col: str, text: Column) -> Column:
    return F.xxhash64(F.col(f"`{id_col}`"), text)


def _matches(text: Column, pattern: str, group: int) -> Column:
    """Array of (gap, size, part): code points since the last match, of the
    match, and the text of the measured group. Null if there is none."""
    length = lambda x: F.length(x)
    gaps = F.transform(F.split(text, pattern, -1), length)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    return F.when(text.rlike(pattern), F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(whole)).alias("gap"), F.transform(whole, length).alias("size"), part.alias("part")))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """(row, kind, start, end) of every finding, certain or linked; row is the
    hash of id and text."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    every = {**CERTAIN, **WEAK}
    found = docs.select(_row_key(id_col, text).alias("row"), text.alias("text")).select(
        "row", *(_matches(F.col("text"), p, g).alias(kind) for kind, (p, g, _, _) in every.items()))
    found = found.where(F.coalesce(*(F.col(k)[0]["size"] for k in every)).isNotNull())
    place = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    long = (found.select("row", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("m")) for k in every))).alias("k"))
            .select("row", "k.kind", F.posexplode("k.m").alias("at", "m")).distinct()       # repeated rows
            .withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(place))
            .withColumn("start", F.col("end") - F.col("m.size")))
    fits = F.lit(False)
    for kind, (_, _, least, most) in every.items():
        ok = (F.col("kind") == kind) & (F.length("m.part") >= least)
        fits = fits | (ok if most is None else ok & (F.length("m.part") <= most))
    mixed = F.col("m.part").rlike("[a-z]") & F.col("m.part").rlike("[A-Z]") & F.col("m.part").rlike("[0-9]")
    spans = stored(docs.sparkSession, long.where(fits & ((F.col("kind") != "key") | mixed)).select("row", "kind", "start", "end"), "spans")
    return spans.where(F.col("kind").isin(*CERTAIN)).unionByName(link(spans, reach))


def link(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak spans with a complementary part within ``reach``. An interval
    meets another in the stretches of ``reach`` code points that both touch."""
    stretch = lambda lo, hi: F.explode(F.sequence(F.floor(lo / reach), F.floor(hi / reach)))
    needs = F.create_map(*(x for k, v in NEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    weak = (spans.where(F.col("kind").isin(*WEAK)).withColumn("need", F.explode(needs[F.col("kind")]))
            .withColumn("stretch", stretch(F.col("start"), F.col("end"))).alias("w"))
    parts = (spans.where(F.col("kind").isin(*{k for v in NEEDS.values() for k in v}))
             .withColumn("stretch", stretch(F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") + reach)).alias("p"))
    near = ((F.col("w.row") == F.col("p.row")) & (F.col("w.stretch") == F.col("p.stretch")) & (F.col("w.need") == F.col("p.kind"))
            & (F.col("w.start") <= F.col("p.end") + reach) & (F.col("p.start") <= F.col("w.end") + reach))
    return weak.join(parts, near, "left_semi").select("row", "kind", "start", "end").distinct()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """One row for each row of docs: ``id_col`` and ``findings``, an array of
    (start, kind number, kind, end) in order; empty if there are none."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    # a document's findings are bounded by its text
    own = find_spans(docs, id_col, text_col, reach).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", number.alias("number"), "kind", "end"))).alias("findings"))
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), _row_key(id_col, text).alias("row"))
    empty = F.array().cast(own.schema["findings"].dataType)
    return rows.join(own, "row", "left").select(id_col, F.coalesce("findings", empty).alias("findings"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]", reach: int = REACH) -> DataFrame:
    """docs with every finding in ``text_col`` replaced by ``mask``; findings that
    overlap or touch are replaced together. Rows without findings stay as they
    are."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    row, found = "row", "found"
    while row in docs.columns or found in docs.columns:
        row, found = row + "_", found + "_"
    own = find_spans(docs, id_col, text_col, reach).groupBy(F.col("row").alias(row)).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias(found))
    begin = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("upto"))
    body = F.col(f"`{text_col}`")
    fresh = lambda acc, s: F.struct(F.concat(acc["done"], F.substring(body, (acc["upto"] + 1).cast("int"), (s["start"] - acc["upto"]).cast("int")),
                                             F.lit(mask)).alias("done"), s["end"].alias("upto"))
    more = lambda acc, s: F.struct(acc["done"].alias("done"), F.greatest(acc["upto"], s["end"]).alias("upto"))
    masked = F.aggregate(found, begin, lambda acc, s: F.when((s["start"] <= acc["upto"]) & (acc["upto"] > 0), more(acc, s)).otherwise(fresh(acc, s)),
                         lambda acc: F.concat(acc["done"], F.substring(body, (acc["upto"] + 1).cast("int"), F.length(body))))
    out = (docs.withColumn(row, _row_key(id_col, text)).join(own, row, "left")
           .withColumn(text_col, F.when(F.col(found).isNull(), body).otherwise(masked)))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
