"""Secret scan with DataFrame operations only.

A pattern of wide recall finds candidates: runs of at least MIN_LENGTH key-like
characters that mix letters and digits. A random forest on their length, character
transitions, dictionary coverage, path shape and neighbouring words tells secrets
from false positives. It learns from labelled findings; where none are given, the
findings that FORMATS and BENIGN decide serve as labels, and the forest judges all
candidates, those no format knows included. Only texts with a candidate are split into
words or joined.

The forest is fitted on at most FIT_ROWS labelled findings, taken in hash order;
every candidate of every text is judged.

Edge cases: null and empty texts have no candidates; repeated rows are judged and
redacted alike; with no labelled findings, or of one class only, a candidate counts
as a secret if a format says so; an empty table gives an empty table; names with
two leading underscores are used inside and must not occur among the columns.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spendcast.sources.scratch import scratch_folder

MIN_LENGTH = 12
FIT_ROWS = 20_000
THRESHOLD = 0.5
MASK = "<SECRET>"
TREES, DEPTH, SEED = 20, 6, 7

_RUN = "[A-Za-z0-9+/_=.-]"
CANDIDATE = (
    f"(?<!{_RUN})(?=[A-Za-z+/_=.-]*[0-9])(?=[0-9+/_=.-]*[A-Za-z]){_RUN}{{{MIN_LENGTH},}}"
)
KEYWORD = "(?i)(passw|passwd|pwd|secret|token|api.?key|access.?key|auth|bearer|credential|private.?key)"
# Public formats of keys, and shapes that are no secrets.
FORMATS = (
    "^(AKIA|ASIA)[0-9A-Z]{16}$", "^gh[pousr]_[A-Za-z0-9]{36}$", "^xox[abprs]-[A-Za-z0-9-]{10,}$",
    "^sk_(live|test)_[A-Za-z0-9]{16,}$", "^AIza[A-Za-z0-9_-]{35}$", "^eyJ[A-Za-z0-9_=-]+\\.[A-Za-z0-9_=-]+",
)
BENIGN = (
    "^[a-z0-9-]+(\\.[a-z0-9-]+)*\\.(com|org|net|edu|io|de|fr|es|html?|php|js|css|png|jpe?g|pdf)/?$",
    "^[A-Za-z]+[0-9]{1,4}[.]?$", "^[0-9]{1,4}([./-][0-9A-Za-z]{1,9}){1,3}$", "^([A-Za-z]{2,}[./_-]+)+[A-Za-z0-9]{0,4}[.]?$",
)
# Words that mark names rather than keys.
DICTIONARY = (
    "mail", "example", "test", "sample", "dummy", "placeholder", "changeme", "default", "user", "admin", "home", "path",
    "file", "image", "index", "page", "site", "www", "http", "https", "html", "com", "org", "net", "version", "release",
    "data", "document", "license", "copyright", "article", "section", "chapter", "figure", "table", "item", "number",
    "the", "and", "for", "with", "that", "this", "from", "have", "not", "are", "was", "you", "der", "die", "und", "les",
    "des", "que", "una", "los", "pour", "avec",
)
FEATURES = (
    "length", "transitions", "digits", "uppers", "lowers", "variety", "hex", "prefix", "dictionary", "dots", "slashes", "dashes",
    "path", "before", "before2", "assigned", "quoted", "after",
)


def has_candidate(text: Column | str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(CANDIDATE) if isinstance(text, str) else text.rlike(CANDIDATE), F.lit(False))


def candidates(docs: DataFrame, path: str | None = "source") -> DataFrame:
    """``__row, value, word, before, before2, after, path``: one row per candidate.

    ``value`` is the run without a leading ``name=``; ``path`` is the column that
    says where a text comes from."""
    origin = F.col(path).cast("string") if path in docs.columns else F.lit(None).cast("string")
    held = docs.filter(has_candidate()).select("__row", "text", origin.alias("path"))
    words = held.withColumn("words", F.split("text", "[\\x20\\x09-\\x0D]+")).drop("text")
    spots = words.withColumn(
        "i", F.explode(F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).rlike(CANDIDATE)))
    )
    near = spots.select(
        "__row", "path", F.get("words", F.col("i")).alias("word"), F.coalesce(F.get("words", F.col("i") - 1), F.lit("")).alias("before"),
        F.coalesce(F.get("words", F.col("i") - 2), F.lit("")).alias("before2"), F.coalesce(F.get("words", F.col("i") + 1), F.lit("")).alias("after"),
    )
    runs = near.withColumn("run", F.explode(F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0))))
    value = F.regexp_replace("run", "^[A-Za-z_.-]{2,40}=+|[.=-]+$", "")
    return runs.withColumn("value", value).filter(F.length("value") >= MIN_LENGTH - 4)


def features(found: DataFrame) -> DataFrame:
    """Numeric columns FEATURES of candidates."""
    n = F.length("value")
    share = lambda pattern: F.regexp_count("value", F.lit(pattern)) / n
    says = lambda c, pattern: F.coalesce(F.col(c).rlike(pattern).cast("double"), F.lit(0.0))
    named = F.regexp_replace(F.lower("value"), "(" + "|".join(sorted(DICTIONARY, key=len, reverse=True)) + ")", "")
    made = {
        "length": n, "transitions": share("[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])"),
        "digits": share("[0-9]"), "uppers": share("[A-Z]"), "lowers": share("[a-z]"),
        "variety": F.size(F.array_distinct(F.split("value", ""))) / n, "hex": says("value", "^[0-9a-fA-F]+$"),
        "prefix": says("value", "^[A-Z]{4}[0-9A-Z]{12,}$|^[a-z]{2,4}[_-][A-Za-z0-9]{16,}"),
        "dictionary": 1 - F.length(named) / n, "dots": share("[.]"), "slashes": share("/"), "dashes": share("[_-]"),
        "path": says("path", "(?i)(test|example|sample|doc|mock)"),
        "before": says("before", KEYWORD), "before2": says("before2", KEYWORD),
        "assigned": F.greatest(says("before", "[=:]$"), says("word", KEYWORD.replace("(?i)", "(?i)^[^=]*") + "[^=]*=")),
        "quoted": says("word", "^[\"'`]"), "after": says("after", KEYWORD),
    }
    return found.withColumns({f"f_{k}": v.cast("double") for k, v in made.items()})


def rule_label(value: str = "value") -> Column:
    """1 or 0 where a format is sure, else null."""
    secret = F.lit(False)
    for p in FORMATS:
        secret |= F.col(value).rlike(p)
    keyed = ((F.col("f_assigned") > 0) & (F.col("f_before") + F.col("f_before2") + F.col("f_assigned") > 1) | F.col("word").rlike(KEYWORD.replace("(?i)", "(?i)^\\W*") + "\\w*=")) & (
        F.col("f_digits") > 0.1
    ) & (F.col("f_variety") > 0.15)
    benign = F.lit(False)
    for p in BENIGN:
        benign |= F.col(value).rlike(p)
    return F.when(secret | keyed, 1.0).when(benign, 0.0)


def judged(found: DataFrame, labels: DataFrame | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Add ``chance`` and ``secret`` to candidates with features.

    ``labels`` holds findings in the form of ``features`` with a ``label``."""
    sure = found.withColumn("label", rule_label())
    known = (sure if labels is None else labels).filter("label IS NOT NULL")
    columns = [f"f_{c}" for c in FEATURES]
    sample = known.select("label", *columns, F.xxhash64("value", "before", "after").alias("__h")).orderBy("__h").limit(fit_rows)
    path = scratch_folder(found.sparkSession, "findings")
    sample.write.parquet(path)
    sample = found.sparkSession.read.parquet(path)
    if sample.select("label").distinct().count() < 2:
        return sure.withColumn("chance", F.coalesce("label", F.lit(0.0))).withColumn("secret", F.col("chance") >= THRESHOLD)
    vectors = VectorAssembler(inputCols=columns, outputCol="__features")
    forest = RandomForestClassifier(
        featuresCol="__features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, probabilityCol="__p", rawPredictionCol="__raw", predictionCol="__y"
    ).fit(vectors.transform(sample))
    scored = forest.transform(vectors.transform(found)).withColumn("chance", vector_to_array("__p")[1])
    return scored.drop("__features", "__p", "__raw", "__y").withColumn("secret", F.col("chance") >= THRESHOLD)


def scan(docs: DataFrame, path: str | None = "source", labels: DataFrame | None = None) -> DataFrame:
    """All columns of ``docs`` and ``__candidates``, ``__secrets`` (their strings)."""
    keyed = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    store = scratch_folder(docs.sparkSession, "candidates")
    features(candidates(keyed, path)).write.parquet(store)
    found = judged(docs.sparkSession.read.parquet(store), labels)
    # Rows of equal doc_id and text share their findings, each counted once.
    spots = found.groupBy("__row").agg(
        F.collect_set("value").alias("__values"), F.collect_set(F.when(F.col("secret"), F.col("value"))).alias("__secrets")
    ).select("__row", F.size("__values").cast("long").alias("__candidates"), F.array_sort("__secrets", lambda a, b: F.length(b) - F.length(a)).alias("__secrets"))
    none = keyed.filter(~has_candidate()).withColumn("__candidates", F.lit(0).cast("long")).withColumn("__secrets", F.array().cast("array<string>"))
    some = keyed.filter(has_candidate()).join(spots, "__row", "left").withColumn("__candidates", F.coalesce("__candidates", F.lit(0).cast("long"))).withColumn(
        "__secrets", F.coalesce("__secrets", F.array().cast("array<string>"))
    )
    return some.unionByName(none).drop("__row")


def redacted() -> Column:
    """The text with every secret masked, longer ones first."""
    return F.when(F.size("__secrets") > 0, F.aggregate("__secrets", F.col("text"), lambda t, s: F.replace(t, s, F.lit(MASK)))).otherwise(F.col("text"))


def redact(docs: DataFrame, path: str | None = "source", labels: DataFrame | None = None) -> DataFrame:
    """The documents with secrets masked; ``n_chars``, where present, follows the text."""
    done = scan(docs, path, labels).withColumn("text", redacted())
    if "n_chars" in docs.columns:
        changed = F.when(F.size("__secrets") > 0, F.length("text")).otherwise(F.col("n_chars"))
        done = done.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def secrets_query(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: distinct candidates, secrets, and a digest of the masked text."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")
    return scan(docs).select(
        "doc_id", F.col("__candidates").alias("n_candidates"), F.size("__secrets").cast("long").alias("n_secrets"),
        F.sha2(F.coalesce(redacted(), F.lit("")), 256).alias("redacted_sha256"),
    )
