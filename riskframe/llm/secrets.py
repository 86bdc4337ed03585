"""Secret scan with multipart credential linking, in DataFrame functions alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import stage, text_of

# Patterns, the part of a match whose length counts, and that length, in the order of kinds.
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),  # the maximal runs of [0-9a-f]+ that are long enough
}
# Weak candidates: reported only beside what completes them.
WEAK = {
    "weak_id": (r"""(?i:(?<!secret)(?<!secret[_-])access_?key(?:_?id)?|client_?id|user_?name|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@=-]+)""", 1, 3),
    "weak_secret": (r"(?<![0-9A-Za-z])(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{12,31}(?![0-9A-Za-z])", 0, 12),
    "weak_key": (r"""(?i:secret[_-]?access[_-]?key|client[_-]?secret|private[_-]?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    # a run of general shape that is not wholly a weak_secret
    "weak_token": (r"(?<![A-Za-z0-9+/_=-])(?![0-9a-f]{12,31}(?![A-Za-z0-9+/_=-]))(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,}", 0, 16),
    "endpoint": (r"https?://[^\x00-\x20\x22\x27<>]+|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])", 0, 7),
}
ROLES = {"access": "id", "weak_id": "id", "assign": "secret", "hex": "secret", "weak_secret": "secret", "weak_key": "secret", "weak_token": "secret", "endpoint": "endpoint"}
ORDER = [*BASE, *WEAK]
#: Characters around a weak candidate in which its complement must start.
SCOPE = 200
KEY = ["doc_id", "node"]


def matches(texts: DataFrame, kind: str) -> DataFrame:
    """doc_id, node, kind, start and stop (code points) of all long enough matches of a kind.

    Leftmost non-overlapping matches of the pattern are laid between the pieces that they
    split the text into, so a running sum of lengths gives their positions.
    """
    pattern, part, least = (BASE | WEAK)[kind]
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all("text", F.lit(pattern), F.lit(part))
    between = F.split("text", pattern, -1)
    zipped = F.arrays_zip(
        F.transform(found, F.length).alias("found"), F.transform(measured, F.length).alias("measured"),
        F.transform(F.slice(between, F.lit(1), F.size(found)), F.length).alias("gap"),
    )
    rows = texts.where(F.col("text").rlike(pattern)).select(*KEY, F.posexplode(zipped).alias("i", "m"))
    so_far = Window.partitionBy(*KEY).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("m.gap") + F.col("m.found")).over(so_far)
    return rows.withColumn("stop", stop).where(F.col("m.measured") >= least).select(
        *KEY, F.lit(kind).alias("kind"), (F.col("stop") - F.col("m.found")).alias("start"), "stop"
    )


def linked(weak: DataFrame, parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak candidates whose complement starts within ``scope`` characters of them.

    An interval join over cells of ``scope`` characters: per document, cell and role only
    the first and last start are kept, which decides nearness exactly, so no two parts of a
    document are paired. An identifier needs a secret; a secret an identifier or an
    endpoint; an endpoint both of the others.
    """
    cells = parts.groupBy(*KEY, F.floor(F.col("start") / scope).alias("cell"), "role").agg(F.min("start").alias("low"), F.max("start").alias("high"))
    cells = cells.withColumnsRenamed({"doc_id": "_d", "node": "_n", "role": "other", "cell": "_c"})
    reach = F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("stop") + scope) / scope))
    asked = weak.withColumn("cell", F.explode(reach)).join(
        cells,
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("node") == F.col("_n"))
        & (F.col("cell") == F.col("_c")) & (F.col("role") != F.col("other")),
    )
    near = (F.col("high") >= F.col("start") - scope) & (F.col("low") <= F.col("stop") + scope)
    seen = asked.where(near).groupBy(*KEY, "kind", "role", "start", "stop").agg(F.collect_set("other").alias("others"))
    beside = {r: F.array_contains("others", r) for r in ("id", "secret", "endpoint")}
    complete = (
        ((F.col("role") == "id") & beside["secret"])
        | ((F.col("role") == "secret") & (beside["id"] | beside["endpoint"]))
        | ((F.col("role") == "endpoint") & beside["id"] & beside["secret"])
    )
    return seen.where(complete).select(*KEY, "kind", "start", "stop")


def secret_scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """All secrets of each text: one row per document.

    Columns: doc_id, n_assign, n_access, n_hex, base_sha256 (of ``kind:start:stop`` of the
    base kinds, by start, then kind, comma-joined; code points, stop exclusive) and spans
    (the same text, with linked weak candidates). A weak candidate that overlaps a base
    span is not reported, nor a weak_token (16 or more characters with a digit and a letter)
    that overlaps an identifier, an endpoint or a weak_key; a weak_secret inside a
    weak_token is reported beside it. NULL and empty texts have none; repeated rows give repeated results; an
    empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("node"), text_of().alias("text"))
    some = reduce(lambda a, b: a | b, [F.col("text").rlike(p) for p, _, _ in BASE.values()])
    # a weak candidate needs a complement; two weak ones may complete each other
    has = {k: F.col("text").rlike(p) for k, (p, _, _) in WEAK.items()}
    some = some | ((has["weak_id"] | has["endpoint"]) & (has["weak_secret"] | has["weak_key"] | has["weak_token"]))
    texts = stage(source.where(some).dropDuplicates(KEY))
    found = stage(reduce(DataFrame.unionByName, [matches(texts, k) for k in ORDER]))
    role = F.element_at(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv]), F.col("kind"))
    parts = found.withColumn("role", role)
    base = F.col("kind").isin(*BASE)
    # weak candidates that overlap a base span, and tokens that overlap a key, an identifier or an endpoint too:
    # the last stop of such spans among earlier starts, or their next start, lies inside
    token = F.col("kind") == "weak_token"
    rank = F.when(base, 0).when(token, 2).otherwise(1)
    by = Window.partitionBy(*KEY).orderBy("start", rank).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*KEY).orderBy(F.col("start").desc(), rank).rowsBetween(Window.unboundedPreceding, -1)

    def covered(cover):
        return (F.coalesce(F.max(F.when(cover, F.col("stop"))).over(by), F.lit(-1)) > F.col("start")) | (
            F.coalesce(F.min(F.when(cover, F.col("start"))).over(after), F.lit(1 << 60)) < F.col("stop")
        )

    parts = parts.withColumn("covered", F.when(token, covered(~F.col("kind").isin("weak_token", "weak_secret"))).otherwise(covered(base)))
    parts = stage(parts.where(base | ~F.col("covered")).drop("covered"))
    seen = linked(parts.where(~base), parts, scope)
    reported = parts.where(base).select(*KEY, "kind", "start", "stop").unionByName(seen)
    place = F.array_position(F.array(*map(F.lit, ORDER)), F.col("kind"))
    span = F.struct("start", place.alias("place"), F.concat_ws(":", "kind", "start", "stop").alias("text"))
    listed = reported.groupBy(*KEY).agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
        F.array_sort(F.collect_list(F.when(base, span))).alias("base"), F.array_sort(F.collect_list(span)).alias("every"),
    )
    listed = listed.select(
        F.col("doc_id").alias("_d"), F.col("node").alias("_n"), *[f"n_{k}" for k in BASE],
        F.array_join("base.text", ",").alias("base_text"), F.array_join("every.text", ",").alias("spans"),
    )
    joined = source.select(*KEY).join(listed, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("node") == F.col("_n")), "left")
    return joined.select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base_text", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )
