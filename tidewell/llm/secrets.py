"""Secret scans over an incremental blob ledger, in DataFrame operations only.

Every version of a text is addressed by its SHA-256. The ledger has a row for each blob and scan: the rule versions that
were applied and what they found. A scan reads each blob once, applies to it only rules whose version it hasn't met, adds
the findings to the ledger, and joins the findings of the current rules back to all rows that hold the blob.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import shared_path, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of pattern of which the given group has at least the given length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    #: Without one of these texts there can be no match.
    needs: tuple[str, ...] = ()
    base: bool = False

    @property
    def version(self) -> str:
        return f"{self.kind}@{hashlib.sha256(repr((self.pattern, self.group, self.least)).encode()).hexdigest()[:12]}"


# The contract's patterns, then further token formats that their issuers publish.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, ("AKIA",), base=True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, base=True),
    Rule("pem", r"-----BEGIN [A-Z0-9 ]++(?<= PRIVATE KEY)-----", 0, 1, ("PRIVATE KEY-----",)),
    Rule("github", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{40,})", 0, 40, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_")),
    Rule("slack", r"\bxox[abeoprs]-[A-Za-z0-9-]{10,}", 0, 15, ("xox",)),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30, ("eyJ",)),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}", 0, 39, ("AIza",)),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}", 0, 24, ("k_live_", "k_test_")),
    Rule("urlauth", r"(?<![a-z])[a-z][a-z0-9+.-]++://[^\s/:@]++:[^\s/:@]{3,}+@", 0, 8, ("://",)),
)

#: Values of the short hash by which a scan passes over texts that the ledger has seen. It does so well while fewer blobs are new.
PREFIXES = 1 << 20

LEDGER = "blob binary, versions array<string>, found array<struct<version: string, start: long, end: long>>"


def _applies(rule: Rule, text: Column) -> Column:
    test = F.rlike(text, F.lit(rule.pattern))
    if rule.needs:
        some = F.lit(False)
        for need in rule.needs:
            some = some | F.contains(text, F.lit(need))
        test = some & test
    return test


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, version, start, end: matches in blobs (blob, text, todo: versions to apply); code points, end exclusive.

    A rule's matches are taken out of the text, and the pieces in between are left; the running sum of both lengths
    gives the places. Only rows with a match pay for that, and a text with many matches is summed over rows.
    """
    todo = F.array_compact(F.array(*[F.when(F.array_contains("todo", r.version) & _applies(r, F.col("text")), F.lit(i)) for i, r in enumerate(rules)]))
    hits = blobs.select("blob", "text", todo.alias("_hits")).filter(F.size("_hits") > 0).select("blob", "text", F.explode("_hits").alias("_rule"))

    def of(value) -> Column:
        out = F.lit(None)
        for i, rule in reversed(list(enumerate(rules))):
            out = F.when(F.col("_rule") == i, value(rule)).otherwise(out)
        return out

    lengths = lambda texts: F.transform(texts, lambda x: F.length(x).cast("long"))
    between = of(lambda r: lengths(F.split("text", r.pattern, -1)))
    whole = of(lambda r: lengths(F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))))
    group = of(lambda r: lengths(F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group))))
    parts = hits.select("blob", "_rule", F.posexplode(F.arrays_zip(between.alias("gap"), whole.alias("whole"), group.alias("group"))).alias("_n", "_m"))
    run = Window.partitionBy("blob", "_rule").orderBy("_n")
    parts = parts.withColumn("_end", F.sum(F.col("_m.gap") + F.coalesce(F.col("_m.whole"), F.lit(0))).over(run.rowsBetween(Window.unboundedPreceding, 0)))
    least = of(lambda r: F.lit(r.least))
    found = parts.filter(F.col("_m.whole").isNotNull() & (F.col("_m.group") >= least))
    return found.select("blob", of(lambda r: F.lit(r.version)).alias("version"), (F.col("_end") - F.col("_m.whole")).alias("start"), F.col("_end").alias("end"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; empty where none has been written."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LEDGER)


def update_ledger(texts: DataFrame, blobs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scans what the ledger at path hasn't seen of texts (blob, text) and appends it; the ledger. blobs: those of texts."""
    spark = texts.sparkSession
    versions = F.array(*[F.lit(r.version) for r in rules])
    seen = read_ledger(spark, path).groupBy("blob").agg(F.flatten(F.collect_set("versions")).alias("seen"))
    todo = F.array_except(versions, F.coalesce("seen", F.array().cast("array<string>")))
    unseen = blobs.select("blob").distinct().join(seen, "blob", "left").select("blob", todo.alias("todo")).filter(F.size("todo") > 0)
    unseen = written(unseen, "ledger-unseen")
    # Of a blob's copies one text goes on; the others are dropped before the shuffle. Where a ledger is there, texts whose
    # blobs share no short hash with an unseen one stay where they lie: at most PREFIXES hashes go to all tasks.
    if not seen.isEmpty():
        prefix = F.pmod(F.xxhash64("blob"), F.lit(PREFIXES)).alias("prefix")
        texts = texts.join(F.broadcast(unseen.select(prefix).distinct()), prefix == F.col("prefix"), "left_semi")
    once = texts.groupBy("blob").agg(F.first("text").alias("text")).join(unseen, "blob")
    found = scan(once, rules).groupBy("blob").agg(F.collect_list(F.struct("version", "start", "end")).alias("found"))
    none = F.array().cast("array<struct<version: string, start: long, end: long>>")
    unseen.join(found, "blob", "left").select("blob", F.col("todo").alias("versions"), F.coalesce("found", none).alias("found")).write.mode("append").parquet(path)
    return read_ledger(spark, path)


def spans_of(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, n_<kind> for base kinds, base (text of base spans), spans (text of all): blobs where the rules found something."""
    kinds = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.version, i)])
    names = F.array(*[F.lit(r.kind) for r in rules])
    found = ledger.select("blob", F.explode("found").alias("f")).select("blob", F.element_at(kinds, F.col("f.version")).alias("rule"), "f.start", "f.end").filter("rule is not null")
    spans = F.array_sort(F.collect_set(F.struct("start", "rule", "end")))
    text = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", F.element_at(names, s["rule"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = [i for i, r in enumerate(rules) if r.base]
    rows = found.groupBy("blob").agg(spans.alias("s"))
    counts = [F.expr(f"cast(size(filter(s, x -> x.rule = {i})) as long)").alias(f"n_{rules[i].kind}") for i in base]
    return rows.select("blob", *counts, text(F.filter("s", lambda x: x["rule"].isin(base))).alias("base"), text(F.col("s")).alias("spans"))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_<kind> of each base kind, base_sha256, spans: a row for each row of docs, after a scan of what is new.

    Each row is a path with one version of its text; null counts as empty, an empty text has no secret. Repeated rows
    each give a row. Without a ledger's path a new one is begun in the shared folder. Spans are kind:start:end by start,
    then by kind in the order of the rules, in code points with the end exclusive; base_sha256 covers those of base kinds.
    """
    path = ledger or shared_path(docs.sparkSession, "secret-ledger")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    paths = written(rows.select("doc_id", "blob"), "secret-paths")
    found = written(spans_of(update_ledger(rows.select("blob", "text"), paths, path, rules), rules), "secret-spans")
    zero = [F.coalesce(F.col(f"n_{r.kind}"), F.lit(0).cast("long")).alias(f"n_{r.kind}") for r in rules if r.base]
    return paths.join(found, "blob", "left").select("doc_id", *zero, F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
