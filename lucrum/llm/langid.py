"""Language identification by Bayesian evidence fusion.

Four kinds of evidence on a page's language are multiplied: the likelihood of
its text under character n-gram models learned from labelled documents, the
language its markup declares, a language code in its address, and a prior for
its host. What a declaration or an address code is worth is learned from the
pages themselves, as counts weighted by the text's posterior. Host priors are
grouped sums of these posteriors, smoothed by the parent domain's, that by the
top-level domain's, that by all pages'; a page's own share is taken out of every
sum that judges it.

Texts are scored in every task of the scan; the rest is grouped aggregation and
joins. The n-gram models are fitted on at most ``max_rows`` labelled documents of
each language, those of smallest id hash, so every language with a labelled
document can be answered, however rare. A model has a fixed number of hashed
features, half a megabyte, for each language.

Null or empty text gives no evidence, nor do a missing declaration, code or
host; with no evidence at all the answer is the commonest language. Null ids and
repeated rows are pages like others. Without labelled documents the language is
null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lucrum.llm.common import stored
from lucrum.llm.urlfilter import host

ORDERS = (1, 2, 3)
BITS = 16
MAX_ROWS = 1_000        # labelled documents that a language's model is fitted on, at most
SLICES = 16
CHUNK = 1 << 20
TEMPER = 0.5            # n-grams overlap: each counts for half
SMOOTH = {"host": 4.0, "domain": 8.0, "tld": 16.0}      # pages that the wider prior is worth
DOUBT = 0.5             # pseudo-count of each declaration and code


def _numbers(text: str) -> Iterator[np.ndarray]:
    """Feature numbers of a text's character n-grams, over bytes, by chunks."""
    buf = np.frombuffer(text.lower().encode(), np.uint8)
    for lo in range(0, len(buf), CHUNK):
        part = buf[lo:lo + CHUNK + max(ORDERS) - 1].astype(np.uint32)
        for n in ORDERS:
            if len(part) >= n:
                h = np.full(len(part) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
                for k in range(n):
                    h = (h ^ part[k:len(part) - n + 1 + k]) * np.uint32(0x01000193)
                    h ^= h >> np.uint32(15)
                yield h >> np.uint32(32 - BITS)


class TextModel:
    """Log likelihood of a text in each language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        totals = counts.sum(1, keepdims=True)
        self.table = np.log((counts + 0.1) / (totals + 0.1 * counts.shape[1])).astype(np.float32)

    def posterior(self, text: str | None) -> np.ndarray:
        score = np.zeros(len(self.languages))
        for found in _numbers(text or ""):
            n = np.bincount(found, minlength=1 << BITS)
            at = np.flatnonzero(n)
            score += self.table[:, at] @ n[at]
        score = TEMPER * score
        p = np.exp(score - score.max()) if len(score) else score
        return p / p.sum() if len(p) else p


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        max_rows: int = MAX_ROWS) -> TextModel | None:
    """n-gram counts by language over the sample, summed by group; what reaches
    the driver is a fixed table for each language. The sample is taken within
    slices of a language's ids first, so a language brings at most ``SLICES``
    times ``max_rows`` ids to one task, whatever its share."""
    place = lambda *by: F.row_number().over(Window.partitionBy("lang", *by).orderBy(F.xxhash64("id"), "id"))
    rows = (labelled.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
            .where("id is not null and lang is not null").distinct()
            .withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(SLICES)))
            .withColumn("place", place("slice")).where(F.col("place") <= max_rows)
            .withColumn("place", place()).where(F.col("place") <= max_rows).drop("slice", "place"))
    texts = labelled.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                            F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = total.setdefault(lang, np.zeros(1 << BITS, np.int64))
                for found in _numbers(text.as_py()):
                    own += np.bincount(found, minlength=1 << BITS)
        for lang, own in total.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang], "counts": [own.tobytes()]})

    def add(rows: pa.Table) -> pa.Table:
        own = np.sum([np.frombuffer(x.as_py(), np.int64) for x in rows["counts"]], axis=0)
        return pa.table({"lang": rows["lang"][:1], "counts": [own.tobytes()]})

    got = (texts.join(F.broadcast(rows), ["id", "lang"]).select("lang", "text").mapInArrow(count, "lang string, counts binary")
           .groupBy("lang").applyInArrow(add, "lang string, counts binary").collect())
    got.sort(key=lambda r: r.lang)
    return TextModel([r.lang for r in got], np.stack([np.frombuffer(r.counts, np.int64) for r in got])) if got else None


def page_text(html: Column) -> Column:
    """Visible text of a page's markup."""
    text = F.regexp_replace(html, r"(?is)<(script|style|nav|head)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"(?s)<[^>]*>", " "), r"\s+", " "))


def declared(html: Column) -> Column:
    """Language that the markup declares, without its region; null if none."""
    code = F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return F.when(code != "", code)


def address_code(url: Column) -> Column:
    """Two-letter code in an address: its first path segment, or else its
    country domain; null if none."""
    path = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+/([A-Za-z]{2})(?:[/?#]|$)", 1))
    tld = F.regexp_extract(host(url), r"\.([a-z]{2})$", 1)
    return F.when(path != "", path).when(tld != "", tld)


def identify(pages: DataFrame, model: TextModel | None, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html") -> DataFrame:
    """One row for each row of pages: ``id_col``, lang, confidence (its posterior),
    text_lang (by text alone; null without text), declared, address_code, host."""
    languages = model.languages if model else []
    sent = pages.sparkSession.sparkContext.broadcast(model)
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    url = F.col(f"`{url_col}`")
    src = pages.select(F.col(f"`{id_col}`").alias("id"), host(url).alias("host"), declared(html).alias("declared"),
                       address_code(url).alias("code"), page_text(html).alias("text"))
    keep = src.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            got = [own.posterior(t.as_py()).tolist() if own else [] for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array([bool(t.as_py()) for t in batch.column(len(keep))]),
                 pa.array(got, pa.list_(pa.float64()))], [*keep, "has_text", "p"])

    kind = src.schema["id"].dataType.simpleString()
    read = stored(pages.sparkSession, src.mapInArrow(
        run, f"id {kind}, host string, declared string, code string, has_text boolean, p array<double>"), "read")
    if not languages:
        return read.select(F.col("id").alias(id_col), F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"),
                           F.lit(None).cast("string").alias("text_lang"), "declared", F.col("code").alias("address_code"), "host")
    n = len(languages)
    # a page without text spreads its count over all languages
    rows = (read.withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1))
            .withColumn("tld", F.regexp_extract("host", r"([^.]+)$", 1)))
    sums = [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(n)]

    def totals(column: str, name: str) -> DataFrame:
        return rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.array(*sums).alias(name))

    all_pages = [float(x or 0) for x in rows.agg(*sums).first()]
    for column in ("host", "domain", "tld"):
        rows = rows.join(totals(column, f"in_{column}"), column, "left")
    for column in ("declared", "code"):
        rows = rows.join(totals(column, f"as_{column}"), column, "left")
    zero = F.array(*[F.lit(0.0)] * n)
    others = lambda name: F.zip_with(F.coalesce(name, zero), F.col("p"), lambda s, p: F.greatest(s - p, F.lit(0.0)))
    size = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    top = F.array(*(F.lit((x + 1) / (sum(all_pages) + n)) for x in all_pages))

    def smoothed(name: str, wider: Column, weight: float) -> Column:
        own = F.col(name)
        return F.zip_with(own, wider, lambda s, w: (s + weight * w) / (size(own) + weight))

    for column, wider in (("tld", None), ("domain", "p_tld"), ("host", "p_domain")):
        rows = rows.withColumn(f"o_{column}", others(f"in_{column}")).withColumn(
            f"p_{column}", smoothed(f"o_{column}", F.col(wider) if wider else top, SMOOTH[column]))
    logs = [F.transform("p_host", lambda x: F.log(x)), F.transform("p", lambda x: F.log(F.greatest(x, F.lit(1e-300))))]
    for column in ("declared", "code"):
        # P(declaration | language) among the other pages, next to that of any declaration
        seen = others(f"as_{column}")
        share = F.zip_with(seen, F.array(*(F.lit(x) for x in all_pages)), lambda s, t: F.log((s + DOUBT) / (t + 2 * DOUBT)))
        logs.append(F.when(F.col(column).isNotNull(), share).otherwise(zero))
    total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), logs)
    rows = rows.withColumn("log", total).withColumn("best", F.array_max("log"))
    names = F.array(*map(F.lit, languages))
    first = lambda a, most: F.element_at(names, F.array_position(a, most).cast("int"))
    return rows.select(
        F.col("id").alias(id_col), first("log", F.col("best")).alias("lang"),
        (1 / size(F.transform("log", lambda x: F.exp(x - F.col("best"))))).alias("confidence"),
        F.when(F.col("has_text"), first("p", F.array_max("p"))).alias("text_lang"), "declared",
        F.col("code").alias("address_code"), "host")
