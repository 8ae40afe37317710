"""Secret scan with multipart credential linking, in DataFrame functions only.

Three kinds are reported wherever they occur: ``assign`` (a keyword given a
value), ``access`` (an access identifier) and ``hex`` (a long run of hex
digits). Three weak kinds are candidates: ``key`` (forty mixed base64
characters on their own), ``user`` (a name given to a user or client id) and
``endpoint`` (a URL). A candidate is reported only where the parts that make a
credential with it lie in its scope, SCOPE code points to either side:
a key beside an identifier (access or user), a user beside a secret (assign or
key) and an endpoint, an endpoint beside an identifier and a secret.

A match's place follows from the lengths of the texts between matches, summed
by a window over the document's matches. Candidates meet other parts in an
interval join: both are dealt to stretches of SCOPE code points, joined by
document and stretch, and only flags are kept of the meetings.

Edge cases: NULL or empty texts hold nothing; every row is scanned by itself,
so repeated rows have equal results; a candidate that overlaps a span reported
anyway is dropped; texts are scanned whole; an empty table gives no rows;
further columns are ignored (``masked`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import stored, table

# Kinds in their order, and the patterns of the first three.
KINDS = ("assign", "access", "hex", "key", "user", "endpoint")
ASSIGN, ACCESS, HEX, KEY, USER, ENDPOINT = range(6)
PATTERNS = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    r"AKIA[A-Z0-9]+",
    r"[0-9a-f]{24,}",
    r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]{0,39}[A-Z])(?=[A-Za-z0-9+/]{0,39}[a-z])(?=[A-Za-z0-9+/]{0,39}[0-9])"
    r"[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])",
    r"""(?i:user(?:name)?|login|client_id|account_id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    r"""https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/?#@!$&()*+,;=%-]*)?""",
)
#: What a text must hold for a kind's pattern to be worth its passes.
GATES = (r"(?i)(?:passw|secret|token|api_?key)", "AKIA", r"[0-9a-f]{24}", r"[A-Za-z0-9+/]{40}", r"(?i)(?:user|login|client_id|account_id)", "://")
LEAST_VALUE, LEAST_ACCESS = 6, 20
SCOPE = 200
MASK = "[SECRET]"


def _raw(text: Column, kind: int) -> Column:
    """One struct per match: kind, number, code points before it since the match before, its length, whether it counts."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(2)) if kind == ASSIGN else None
    zipped = F.arrays_zip(*[c.alias(n) for c, n in ((F.split(text, PATTERNS[kind], -1), "gap"), (found, "match"), (value, "value"))
                            if c is not None])

    def one(z: Column, i: Column) -> Column:
        length = F.length(z["match"])
        ok = F.length(z["value"]) >= LEAST_VALUE if kind == ASSIGN else length >= LEAST_ACCESS if kind == ACCESS else F.lit(True)
        return F.struct(F.lit(kind).alias("kind"), i.alias("nth"), F.length(z["gap"]).alias("gap"), length.alias("len"), ok.alias("ok"))
    made = F.filter(F.transform(zipped, one), lambda s: s["len"].isNotNull())
    gate = text.contains(GATES[kind]) if kind in (ACCESS, ENDPOINT) else text.rlike(GATES[kind])
    return F.when(gate, made).otherwise(F.array().cast("array<struct<kind:int,nth:int,gap:int,len:int,ok:boolean>>"))


def matches(docs: DataFrame) -> DataFrame:
    """rid, doc_id and raw matches of each row, written once: rid names the row from here on."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return stored(docs.sparkSession, docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", F.xxhash64("doc_id", "text").alias("row"),
        F.concat(*[_raw(text, k) for k in range(len(KINDS))]).alias("raw")), "secret-matches")


def spans(found: DataFrame) -> DataFrame:
    """(rid, kind, start, end) of all reported spans of ``matches``' rows."""
    each = found.filter(F.size("raw") > 0).select("rid", F.explode("raw").alias("m")).select("rid", "m.*")
    upto = Window.partitionBy("rid", "kind").orderBy("nth")
    end = F.sum(F.col("gap").cast("long") + F.col("len")).over(upto)
    placed = each.select("rid", "kind", (end - F.col("len")).alias("start"), end.alias("end"), "ok").filter("ok").drop("ok")
    placed = stored(found.sparkSession, placed, "secret-parts")
    strong, weak = placed.filter(F.col("kind") <= HEX), placed.filter(F.col("kind") > HEX)
    reach = weak.select("*", F.explode(F.sequence(F.floor((F.col("start") - SCOPE) / SCOPE), F.floor((F.col("end") + SCOPE) / SCOPE))).alias("bin"))
    part = placed.select("rid", F.col("kind").alias("k"), F.col("start").alias("s"), F.col("end").alias("e"),
                         F.explode(F.sequence(F.floor(F.col("start") / SCOPE), F.floor((F.col("end") - 1) / SCOPE))).alias("bin"))
    meets = (F.col("s") < F.col("end") + SCOPE) & (F.col("e") > F.col("start") - SCOPE)
    has = lambda *kinds: F.max(F.col("k").isin(*kinds))
    flags = reach.join(part, ["rid", "bin"]).filter(meets & (F.col("k") != F.col("kind"))).groupBy("rid", "kind", "start", "end").agg(
        has(ACCESS, USER).alias("identifier"), has(ASSIGN, KEY).alias("secret"), has(ENDPOINT).alias("place"),
        F.max((F.col("k") <= HEX) & (F.col("s") < F.col("end")) & (F.col("e") > F.col("start"))).alias("reported"))
    rule = (F.when(F.col("kind") == KEY, F.col("identifier")).when(F.col("kind") == USER, F.col("secret") & F.col("place"))
            .otherwise(F.col("identifier") & F.col("secret")))
    return strong.union(flags.filter(rule & ~F.col("reported")).select("rid", "kind", "start", "end"))


def span_lists(found: DataFrame) -> DataFrame:
    """``matches``' rows with their spans, in order of start and kind: array of (start, kind, end)."""
    lists = spans(found).groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return found.select("rid", "doc_id", "row").join(lists, "rid", "left").withColumn("spans", F.coalesce("spans", none))


def _told(which: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(which, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def masked(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with MASK in place of every reported span of ``text``
    (overlapping spans make one). Rows with spans are joined by a hash of doc_id
    and text; the others pass as they are."""
    lists = span_lists(matches(docs)).filter(F.size("spans") > 0).groupBy("row").agg(F.first("spans").alias("spans"))
    lists = stored(docs.sparkSession, lists.withColumnRenamed("row", "_row").withColumnRenamed("spans", "_spans"), "secret-lists")
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(apart, F.concat(acc["out"], gap, F.lit(MASK))).otherwise(acc["out"]).alias("out"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("_spans", start, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    joined = docs.withColumn("_row", F.xxhash64("doc_id", "text")).join(lists, "_row", "left")
    return joined.withColumn("text", F.when(F.col("_spans").isNotNull(), clean).otherwise(text)).select(*docs.columns)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all documents."""
    rows = span_lists(matches(table(spark, sf_dir, "documents")))
    base = F.filter("spans", lambda s: s["kind"] <= HEX)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return rows.select("doc_id", count(ASSIGN).alias("n_assign"), count(ACCESS).alias("n_access"), count(HEX).alias("n_hex"),
                       F.sha2(_told(base).cast("binary"), 256).alias("base_sha256"), _told(F.col("spans")).alias("spans"))
