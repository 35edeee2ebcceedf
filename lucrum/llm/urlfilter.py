"""URL filters by a temporal list join. DataFrame functions only.

Lists change: an entry is added on one day and removed on another. Dated events
become validity intervals, and a capture is judged by the entries that were
active when it was fetched: an as-of join on the entry's key and the time.

An entry is a host with its first path segment (h.example.org/blog), a host, or
a parent domain. The most specific active entry decides; where a blocking and an
allowing entry are equally specific, allowing wins. An entry's intervals are
disjoint, so a capture meets each list entry at most once and the join cannot
multiply rows; a host with a third of all captures is a skewed left side only.

Null or unparsable addresses and null times have no active entry and are kept.
Rows are told apart by id, address and time, so null ids and repeated rows are
judged like others. Events with a null list, entry or time are ignored; of
several events of an entry at one time the removal counts. Extra columns of the
captures pass through; no empty table is special.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host(url: Column) -> Column:
    """Lower-case host name of an address, without user name, port and final dots;
    null if there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#\s]*@)?([^/:?#@\s]+)", 1))
    found = F.regexp_replace(found, r"\.+$", "")
    return F.when(found != "", found)


def keys(url: Column) -> Column:
    """Array of (key, depth) that entries can name, the most specific deepest:
    parent domains of two labels or more, the host, the host with its first path
    segment."""
    name = host(url)
    labels = F.split(name, r"\.")
    n = F.size(labels)
    parents = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.struct(
        F.array_join(F.slice(labels, i, n - i + 1), ".").alias("key"), (n - i + 1).alias("depth")))
    segment = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+/([^/?#\s]+)", 1)
    page = F.when(segment != "", F.array(F.struct(F.concat(name, F.lit("/"), segment).alias("key"), (n + 1).alias("depth"))))
    return F.when(name.isNotNull(), F.concat(parents, F.coalesce(page, F.array().cast("array<struct<key:string,depth:int>>"))))


def intervals(events: DataFrame) -> DataFrame:
    """(list, entry, since, until) from events (list, entry, at, added): from an
    addition up to the next removal, until null while it lasts."""
    clean = events.where("list is not null and entry is not null and at is not null and added is not null").groupBy(
        "list", "entry", "at").agg(F.min("added").alias("added"))
    order = Window.partitionBy("list", "entry").orderBy("at")
    changes = clean.withColumn("last", F.lag("added").over(order)).where("added <> coalesce(last, false)")
    return (changes.withColumn("until", F.lead("at").over(order)).where("added")
            .select("list", "entry", F.col("at").alias("since"), "until"))


def judge(captures: DataFrame, events: DataFrame, allowing: tuple[str, ...] = ("allow",), id_col: str = "page_id",
          url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """captures with blocked (boolean), list and entry (of the deciding entry,
    null if none was active) and n_active, the entries active for it. Existing
    columns of these names are replaced."""
    row = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{url_col}`"), F.col(f"`{time_col}`"))
    asked = (captures.select(row.alias("__row"), F.col(f"`{time_col}`").alias("__time"), F.explode(keys(F.col(f"`{url_col}`"))).alias("__k"))
             .where(F.col("__time").isNotNull()).select("__row", "__time", "__k.key", "__k.depth").distinct())
    active = intervals(events)
    hit = asked.join(active, (F.col("key") == F.col("entry")) & (F.col("__time") >= F.col("since"))
                     & (F.col("until").isNull() | (F.col("__time") < F.col("until"))))
    first = F.struct((-F.col("depth")).alias("depth"), F.when(F.col("list").isin(*allowing), 0).otherwise(1).alias("kind"), "list", "entry")
    verdict = hit.groupBy("__row").agg(F.min(first).alias("__v"), F.count("*").alias("__n"))
    out = captures.drop("blocked", "list", "entry", "n_active").withColumn("__row", row).join(verdict, "__row", "left")
    return (out.withColumn("blocked", F.coalesce(F.col("__v.kind") == 1, F.lit(False))).withColumn("list", F.col("__v.list"))
            .withColumn("entry", F.col("__v.entry")).withColumn("n_active", F.coalesce("__n", F.lit(0)).cast("long"))
            .drop("__row", "__v", "__n"))
