"""The thin ``opN_*`` queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """The public byte-level vocabulary that the query is defined on."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and their text again, as digests."""
    from lucrum.llm import bpe
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, vocabulary(), decoded_col="decoded").select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def fifth(column: str = "doc_id"):
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every text, learnt from four fifths of the labels."""
    from lucrum.llm import toxicity
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", use=fifth() != 0)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(fifth() == 0, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op9_lzprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    from lucrum.llm import lzprint
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lzprint.neighbours(docs).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query
def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share nine tenths of their 3-word runs."""
    from lucrum.llm import jaccard
    return jaccard.similar(table(spark, sf_dir, "documents"), words=3, percent=90).select(
        "doc_id", "n_shingles", "component_id", "n_links")


@query
def op2_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every text under the unigram base and the model."""
    from lucrum.llm import interpolation as lm
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    kind = F.when(part == 1, lm.HELD).when(part == 4, lm.TUNED).otherwise(lm.COUNTED)
    return lm.score(table(spark, sf_dir, "documents"), kind).select(
        "doc_id", (F.col("kind") == lm.HELD).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every fiftieth vector."""
    from lucrum.llm import topk
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, in the order of training."""
    from lucrum.llm import mixing
    return mixing.allocate(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]).alias("taken"),
        F.try_element_at("copies", F.lit(1))["position"].alias("position")).orderBy(F.col("position").asc_nulls_last(), "doc_id")


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, places and digest of the secrets in every text."""
    from lucrum.llm import secrets
    found = secrets.scan(table(spark, sf_dir, "documents"))
    listed = lambda rows: F.array_join(F.transform(
        rows, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda *kinds: F.filter("findings", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.CERTAIN),
        F.sha2(listed(of(*secrets.CERTAIN)), 256).alias("base_sha256"), listed(F.col("findings")).alias("spans"))


DAY = 86_400
#: When page 0 was fetched, seconds; pages follow over 120 days.
FETCHED = 1_704_067_200


def list_events(pages: DataFrame) -> DataFrame:
    """Dated list entries for the addresses that occur, by digits of a name's
    hash: hosts and their domains that come on a list, leave it and some return,
    and path segments that are allowed again."""
    from lucrum.llm import urlfilter
    name = urlfilter.host(F.col("url"))
    digit = lambda key, i: F.ascii(F.substring(F.md5(key), i, 1)) % 16
    segment = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+/([^/?#\s]+)", 1)
    hosts = pages.select(name.alias("entry")).where("entry is not null").distinct()
    domains = hosts.select(F.regexp_extract("entry", r"([^.]+\.[^.]+)$", 1).alias("entry")).where("entry <> ''").distinct()
    spots = pages.select(F.concat(name, F.lit("/"), segment).alias("entry")).where(
        name.isNotNull() & (segment != "")).distinct()
    out = None
    for list_name, entries, share in (("spam", hosts, 8), ("adult", domains, 6), ("allow", spots, 5)):
        key = F.concat(F.lit(list_name), F.lit(":"), F.col("entry"))
        steps = F.array(*(F.struct((F.lit(FETCHED) + DAY * (digit(key, 2) * 2 + after * (1 + digit(key, 3)))).cast("long").alias("at"),
                                   F.lit(after != 2).alias("added")) for after in (0, 2, 5)))
        some = entries.where(digit(key, 1) < share).select(F.lit(list_name).alias("list"), "entry", F.explode(steps).alias("e"))
        some = some.select("list", "entry", "e.at", "e.added")
        out = some if out is None else out.unionByName(some)
    return out


@query
def op5_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries active when it was fetched."""
    from lucrum.llm import urlfilter
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.lit(FETCHED) + F.pmod(F.col("page_id") * 7919, F.lit(120 * DAY)))
    return urlfilter.judge(captures, list_events(pages)).select("page_id", "fetched", "blocked", "list", "entry", "n_active")


@query
def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, from its text, markup, address and host."""
    from lucrum.llm import langid
    model = langid.fit(table(spark, sf_dir, "documents"))
    return langid.identify(table(spark, sf_dir, "pages"), model)


@query
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and the cascade's verdict of every text."""
    from lucrum.llm import quality
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), report=counts)
    q = F.col("quality")
    return judged.select("doc_id", *(q[c].alias(c) for c in counts),
                         ((q["n_words"] < 20) | (100 * q["n_repeat_words"] > 30 * q["n_words"])).alias("base_failed"), q["kept"].alias("kept"))


@query
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, a seventh of the labels moved on."""
    from lucrum.llm import negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's strongest phrases of two to four words."""
    from lucrum.llm import collocations
    return collocations.mine(table(spark, sf_dir, "documents"))
