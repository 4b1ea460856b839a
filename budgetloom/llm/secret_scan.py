"""Secret scans over all versions of all texts, with an incremental ledger of blobs.

Every text is addressed by the SHA-256 of its bytes. The ledger has one row for each blob and rule version that was
scanned, with the spans found (maybe none). A scan reads each blob once however many paths hold it, looks for the rule
versions that the ledger lacks, adds a batch of rows, and joins the findings back to all paths. Only built-in
functions run. Spans come from the lengths of what lies between matches and of the matches, in code points.

Defined results: a null text is the empty text. Null paths and repeated rows are kept. A ledger that does not exist
yet is empty. Two scans at once may both add the same blob; readers take one row of each blob and rule version.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from budgetloom.operators.lookup import attach


@dataclass(frozen=True)
class Rule:
    """``keep`` may drop matches: it gets the groups' texts. ``hint`` is a literal that every match holds, if there is one."""

    name: str
    version: int
    pattern: str
    value_group: int = 0
    min_length: int = 0
    hint: str | None = None


#: The three base patterns and their least lengths.
BASE_RULES = (
    Rule("assign", 1, r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)
#: Added to the base kinds: private key headers and signed web tokens.
EXTRA_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, "PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 0, ".eyJ"),
)
RULES = BASE_RULES + EXTRA_RULES
SPANS = "array<struct<start:int,end:int>>"
CHUNK = 512


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def spans_of(text: Column, rule: Rule) -> Column:
    """Spans of the rule's leftmost matches that do not overlap, ends exclusive, in code points.

    The text is split once: its matches, and what lies before each, are one array, which running sums turn into spans.
    Sums run over chunks of that array, so that long results grow by whole chunks and are not copied for every match.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    fits = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.value_group)), lambda v: F.length(v) >= rule.min_length)
    matches = F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), fits.alias("fits"))  # the last has a gap only
    none = F.array().cast(SPANS)

    def step(acc: Column, match: Column) -> Column:
        begin = acc["at"] + match["gap"]
        span = F.struct(begin.alias("start"), (begin + match["size"]).alias("end"))
        return F.struct((begin + match["size"]).alias("at"), F.when(match["fits"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    def chunk(done: Column, part: Column) -> Column:
        start = F.struct(F.element_at(done, -1)["at"].alias("at"), none.alias("spans"))
        return F.concat(done, F.array(F.aggregate(part, start, step)))

    def spans(found: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / CHUNK).cast("int")), lambda c: F.slice(found, c * CHUNK + 1, F.lit(CHUNK)))
        first = F.array(F.struct(F.lit(0).alias("at"), none.alias("spans")))
        return F.aggregate(chunks, first, chunk, lambda done: F.flatten(F.transform(done, lambda x: x["spans"])))

    some = text.rlike(rule.pattern) if rule.hint is None else text.contains(rule.hint) & text.rlike(rule.pattern)
    return F.when(some, F.get(F.transform(F.array(matches), spans), F.lit(0))).otherwise(none)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(f"blob binary, rule string, version int, spans {SPANS}").option("recursiveFileLookup", "true").parquet(ledger)


def scan(versions: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger folder lacks, and return its findings: blob, findings (kind, start, end, in order).

    Blobs without findings are not returned. The order is by start, then in the order of ``rules``.
    """
    spark = versions.sparkSession
    blobs = versions.select(blob_id(F.col(text)).alias("blob"), F.coalesce(text, F.lit("")).alias("body"))
    wanted = F.array(*[F.lit(f"{r.name}:{r.version}") for r in rules])
    known = read_ledger(spark, ledger)
    if known is None:
        missing = blobs.withColumn("missing", wanted)
    else:
        seen = known.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "rule", "version")).alias("seen"))
        missing = attach(blobs, seen, {"blob": F.col("blob")}).withColumn("missing", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
        missing = missing.where(F.size("missing") > 0)
    once = missing.groupBy("blob").agg(F.first("body").alias("body"), F.first("missing").alias("missing"))
    rows = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.when(F.array_contains("missing", f"{r.name}:{r.version}"), spans_of(F.col("body"), r)).alias("spans")) for r in rules]
    fresh = once.select("blob", F.explode(F.filter(F.array(*rows), lambda x: x["spans"].isNotNull())).alias("r")).select("blob", "r.*")
    fresh.write.mode("append").option("compression", "zstd").parquet(ledger)
    return findings(read_ledger(spark, ledger), rules)


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    current = reduce(lambda a, b: a | b, [(F.col("rule") == r.name) & (F.col("version") == r.version) for r in rules])
    found = ledger.where(current & (F.size("spans") > 0)).select("blob", "rule", "version", F.explode("spans").alias("s")).distinct()
    rank = F.element_at(F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)]), F.col("rule"))
    one = F.struct(F.col("s.start").alias("start"), rank.alias("rank"), F.col("s.end").alias("end"), F.col("rule").alias("kind"))
    return found.groupBy("blob").agg(F.array_sort(F.collect_list(one)).alias("findings"))


def with_findings(versions: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``versions``, its text left out, with the findings of its blob (empty where there are none).

    The join is split further where very many paths hold one blob. A column called ``findings`` is replaced.
    """
    kept = [c for c in versions.columns if c not in (text, "findings", "_blob")]
    paths = versions.select(*kept, blob_id(F.col(text)).alias("_blob"))
    joined = attach(paths, found, {"blob": F.col("_blob")})
    return joined.select(*kept, F.coalesce("findings", F.array().cast(found.schema["findings"].dataType)).alias("findings"))
