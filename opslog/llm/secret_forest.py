"""Secrets in text: candidates by pattern, false positives removed by a random forest.

Everything runs on SQL functions and the forest of Spark's own machine-learning library, in the JVM.  A
candidate is a run of at least ``SHORTEST`` key characters with a digit in it, or whatever follows the name of a
secret and ``=`` or ``:``, of ``SHORTEST_NAMED`` characters or more, with or without digits and marks, in quotes or not
(a quotation mark ends it).  The forest sees its
length, how often its characters change class, how many are distinct, how much of it common words
cover, whether it is part of a path or address, and what the words before and after it say.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import saved

SHORTEST = 16
RUN = rf"[A-Za-z0-9+/_=\-]{{{SHORTEST},}}"
CANDIDATE = rf"(?<![A-Za-z0-9+/_=\-])(?=[A-Za-z+/_=\-]*[0-9]){RUN}"
SHORTEST_NAMED = 6
NAME = (
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret(?:[_-]?key)?|(?:auth[_-]?)?token|(?:api|access|private)[_-]?key|"
    r"authorization|credentials?)"
)
QUOTE = r"[\"'`]"
NAMED_TEXT = rf"(?i)(?<![A-Za-z]){NAME}{QUOTE}?\s*[:=]+\s*{QUOTE}?[^\s\"'`]{{{SHORTEST_NAMED}}}"
NAMED_WORD = rf"(?i)(?<![A-Za-z]){NAME}{QUOTE}?[:=]+{QUOTE}?([^\s\"'`]{{{SHORTEST_NAMED},}})"
NAME_BEFORE = rf"(?i)(?<![A-Za-z]){NAME}{QUOTE}?\s*[:=]+\s*{QUOTE}?$"
VALUE_AFTER = rf"^{QUOTE}?([^\s\"'`]{{{SHORTEST_NAMED},}})"
TAIL = r"[,;.)\]}>]+$"
TREES, DEPTH = 24, 8
MAX_FINDINGS = 2000
THRESHOLD = 0.5

# What neighbouring words and names tell.
SECRET_WORDS = "pass(word|wd|phrase)?|pwd|secrets?|tokens?|api|key|keys|auth|authorization|bearer|credentials?|private|access|login"
OTHER_WORDS = (
    "sha(1|224|256|384|512)?|md5|crc(32)?|hash|digest|checksum|commit|revision|rev|uuid|guid|etag|integrity|version|build|isbn|"
    "serial|order|invoice|ticket|example|sample|dummy|test|placeholder|fingerprint|public|file|image|page|doi"
)
DICTIONARY = (
    "the|and|for|with|from|this|that|page|file|image|index|item|list|name|data|user|test|example|sample|number|value|"
    "type|code|main|home|site|view|post|news|blog|article|product|order|invoice|report|version|build|release|update|"
    "service|server|client|config|default|module|class|object|method|function|array|string|table|column|table|node|"
    "your|here|change|insert|replace|placeholder|dummy|document|chapter|section|figure|january|february|march|april|"
    "june|july|august|september|october|november|december|north|south|east|west|com|org|net|www|http|https|html"
)
FEATURES = (
    "length digits uppers lowers marks distinct turns digit_letter letter_digit case_turns hex longest_word covered repeats path "
    "address assigned quoted said_secret said_other near_secret near_other source_example"
).split()


def candidates(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Findings before any judgement: doc_id, word_no, value, and the words around it.

    ``path`` names a column that says where a row comes from.  Only texts with a candidate are
    cut into words; null and empty texts have none, very long ones are read whole, repeated rows count each.
    Of a word, a named value comes first, then runs that it does not hold.
    """
    source = F.col(path).cast("string") if path else F.lit(None).cast("string")
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), source.alias("source")
    ).filter(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(NAMED_TEXT))
    words = docs.select("doc_id", "source", F.split("text", r"\s+").alias("words"))
    placed = words.select("doc_id", "source", F.explode(F.transform("words", _around)).alias("w")).select(
        "doc_id", "source", F.col("w.no").alias("word_no"), "w.word", "w.before", "w.after"
    )
    said = F.regexp_extract("word", NAMED_WORD, 1)
    after = F.when(F.col("before").rlike(NAME_BEFORE), F.regexp_extract("word", VALUE_AFTER, 1)).otherwise(F.lit(""))
    named = F.regexp_replace(F.when(said != "", said).otherwise(after), TAIL, "")
    # A name in front of a value joined by "=" belongs to the context, not to the value.
    runs = F.transform(
        F.regexp_extract_all("word", F.lit(f"({CANDIDATE})"), 1),
        lambda run: F.regexp_replace(run, r"^[A-Za-z_\-]{1,24}=(?=.{8})", ""),
    )
    long_enough = F.length("word") >= SHORTEST_NAMED
    found = placed.filter(long_enough & (F.col("word").rlike(CANDIDATE) | (named != ""))).withColumn("_named", named)
    bare = lambda run: F.regexp_replace(run, r"^[A-Za-z_\-]{1,24}=", "")
    beside = F.filter(runs, lambda run: ~F.contains(F.col("_named"), bare(run)) & ~F.contains(run, F.nullif("_named", F.lit(""))))
    values = F.when(F.col("_named") == "", runs).otherwise(F.concat(F.array("_named"), beside))
    return found.select("doc_id", "source", "word_no", "word", "before", "after", F.posexplode(values).alias("part", "value"))


def _around(word: Column, no: Column) -> Column:
    """A word with its place, up to three words before it and two after it."""
    words, first = F.col("words"), F.greatest(no - 3, F.lit(0)) + 1
    return F.struct(
        no.alias("no"), word.alias("word"),
        F.array_join(F.slice(words, first, F.least(no, F.lit(3))), " ").alias("before"),
        F.array_join(F.slice(words, no + 2, F.lit(2)), " ").alias("after"),
    )


def _count(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)).cast("double")


def with_features(found: DataFrame) -> DataFrame:
    """Adds the columns named in ``FEATURES``."""
    size = F.greatest(F.length("value"), F.lit(1)).cast("double")
    before, said = F.lower(F.coalesce("before", F.lit(""))), F.lower(F.regexp_extract("word", r"([A-Za-z_.\-]*)[\"']?[:=]", 1))
    words = F.lower(F.coalesce("after", F.lit("")))

    def says(text: Column, words: str) -> Column:
        return text.rlike(rf"(^|[^a-z])({words})([^a-z]|$)").cast("double")

    last = F.element_at(F.split(F.regexp_replace(before, r"[\s:=\"']+$", ""), r"\s+"), -1)
    return found.withColumns(
        {
            "length": F.log(size),
            "digits": _count("[0-9]") / size,
            "uppers": _count("[A-Z]") / size,
            "lowers": _count("[a-z]") / size,
            "marks": _count("[^A-Za-z0-9]") / size,
            "distinct": F.size(F.array_distinct(F.split(F.lower("value"), ""))) / F.least(size, F.lit(36.0)),
            "turns": _count(r"[0-9](?=[^0-9])|[^0-9](?=[0-9])") / size,
            "digit_letter": _count(r"[0-9](?=[A-Za-z])") / size,
            "letter_digit": _count(r"[A-Za-z](?=[0-9])") / size,
            "case_turns": _count(r"[a-z](?=[A-Z])|[A-Z](?=[a-z])") / size,
            "hex": F.col("value").rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
            "longest_word": F.array_max(F.transform(F.split("value", "[^A-Za-z]+"), F.length)).cast("double") / size,
            "covered": (size - F.length(F.regexp_replace(F.lower("value"), DICTIONARY, ""))) / size,
            "repeats": _count(r"(.)(?=\1)") / size,
            "path": (_count("/") / size + F.col("word").rlike(r"^[~./]|\.[a-z]{2,4}$").cast("double")),
            "address": F.col("word").rlike(r"(?i)(https?:|www\.|@[a-z])").cast("double"),
            "assigned": (F.col("word").rlike("[:=]") | before.rlike(r"[:=]\s*[\"']?$")).cast("double"),
            "quoted": F.col("word").rlike("^[\"'`]|[=:][\"'`]").cast("double"),
            "said_secret": says(F.concat_ws(" ", F.regexp_replace(said, "[_.-]", " "), F.regexp_replace(last, "[_.-]", " ")), SECRET_WORDS),
            "said_other": says(F.concat_ws(" ", F.regexp_replace(said, "[_.-]", " "), F.regexp_replace(last, "[_.-]", " ")), OTHER_WORDS),
            "near_secret": says(F.concat_ws(" ", before, words), SECRET_WORDS),
            "near_other": says(F.concat_ws(" ", before, words), OTHER_WORDS),
            "source_example": F.coalesce(F.lower("source").rlike("test|example|sample|mock|fixture|doc").cast("double"), F.lit(0.0)),
        }
    )


def fit(findings: DataFrame, label: str = "label") -> RandomForestClassificationModel | None:
    """The forest of labelled findings (columns of ``candidates`` and a label 0/1); None without both labels."""
    rows = with_features(findings).select(*FEATURES, F.col(label).cast("double").alias("label")).na.fill(0.0)
    kinds = rows.select("label").distinct().limit(3).count()
    if kinds < 2:
        return None
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", "label").cache()
    try:
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=17, featureSubsetStrategy="sqrt", maxBins=32)
        return forest.fit(data)
    finally:
        data.unpersist()


def judge(found: DataFrame, model: RandomForestClassificationModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``score`` and ``predicted`` to candidates; without a model every candidate stays, at score 1."""
    if model is None:
        return found.withColumns({"score": F.lit(1.0), "predicted": F.lit(1)})
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(found).na.fill(0.0, FEATURES))
    scored = model.transform(rows).withColumn("score", F.element_at(vector_to_array("probability"), 2))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")).select(*found.columns, "score", "predicted")


def planted_findings(documents: DataFrame, most: int = MAX_FINDINGS) -> DataFrame:
    """Labelled findings where none are at hand: known secrets and known look-alikes put among words of the documents.

    Values come from digests of the row's id, so that none is a real one; contexts are three words of the
    document.  Equal ids give the same findings, an empty table none.  At most ``most`` documents (smallest hash of the id) give one finding of every form.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.filter(F.col("doc_id").isNotNull() & (F.length("text") > 20))
    ids = F.broadcast(rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))  # at most ``most`` numbers
    near = saved(rows.join(ids, "doc_id").select("doc_id", F.slice(F.split("text", r"\s+"), 1, 40).alias("w")), "contexts")
    digest = F.sha2(F.concat_ws("/", F.lit("finding"), "doc_id"), 512)
    near = near.select("doc_id", "w", digest.alias("d"), F.upper(F.translate(F.base64(F.unhex(digest)), "+/=", "XYZ")).alias("u"), F.translate(F.base64(F.unhex(digest)), "+/=", "xyz").alias("m"))
    pick = lambda k: F.element_at("w", (F.abs(F.xxhash64("doc_id", F.lit(k))) % F.size("w") + 1).cast("int"))
    name = lambda k: F.lower(F.regexp_replace(pick(k), r"[^\p{L}]", ""))
    chosen = lambda k, *words: F.element_at(F.array(*[F.lit(w) for w in words]), (F.abs(F.xxhash64("doc_id", F.lit(k))) % len(words) + 1).cast("int"))
    size = lambda k, lo, hi: (F.abs(F.xxhash64("doc_id", F.lit(k))) % (hi - lo + 1) + lo).cast("int")
    secret_name = chosen(1, "password", "passwd", "token", "secret", "api_key", "auth_token", "access_key", "client_secret")
    other_name = chosen(2, "sha1", "md5", "checksum", "commit", "etag", "revision", "integrity", "uuid", "build", "digest")
    hexed = F.substring("d", 1, 64)
    forms = [
        (1, F.concat(secret_name, F.lit("="), F.left(hexed, size(3, 16, 48))), pick(4)),
        (1, F.concat(F.lit('"'), F.left(hexed, size(5, 32, 40)), F.lit('"')), F.concat_ws(" ", pick(6), secret_name, F.lit("="))),
        (1, F.concat(F.lit("AKIA"), F.left("u", F.lit(16))), F.concat_ws(" ", pick(7), pick(8))),
        (1, F.concat(chosen(9, "ghp_", "glpat-", "sk_live_", "xoxb-", ""), F.left("m", size(10, 28, 40))), F.concat_ws(" ", pick(11), secret_name)),
        (1, F.concat(secret_name, F.lit(":"), F.left("m", size(12, 20, 40))), pick(13)),
        (0, F.concat(other_name, F.lit("="), F.left(hexed, size(14, 32, 64))), pick(15)),
        (0, F.left(hexed, size(16, 32, 64)), F.concat_ws(" ", pick(17), other_name, chosen(18, "=", ":", ""))),
        (0, F.concat_ws("_", name(19), name(20), name(21), F.left(F.regexp_replace("d", "[a-f]", ""), F.lit(3)), F.lit("section")), pick(22)),
        (0, F.concat(F.lit("/home/"), name(23), F.lit("/"), name(24), F.lit("/page"), F.left(F.regexp_replace("d", "[a-f]", ""), F.lit(4))), pick(25)),
        (0, F.concat(F.lit("https://"), name(26), F.lit(".example.net/"), name(27), F.lit("/article"), F.left(F.regexp_replace("d", "[a-f]", ""), F.lit(5))), pick(28)),
        (0, F.left(F.regexp_replace("d", "[a-f]", ""), F.lit(18)), F.concat_ws(" ", pick(29), chosen(30, "order", "isbn", "invoice", "serial", ""))),
        (0, F.concat(secret_name, F.lit("="), chosen(31, "xxxxxxxxxxxxxxx1", "your_password_here_1", "change-this-value-123", "0000000000000000", "1234567890123456", "example_token_value_1")), pick(32)),
        (0, F.concat_ws("-", F.lit("2024"), F.lit("01"), name(33), name(34), name(35), F.lit("release")), pick(36)),
    ]
    idle = ("required", "optional", "undefined", "getpass()", "os.environ", "${PASSWORD}", "changeme", "your_password", "********", "string;")
    after_name = lambda k: F.concat_ws(" ", pick(k), F.concat(secret_name, chosen(k + 1, ":", "=", " =", " :")))
    forms += [
        (1, F.left("m", size(41, 8, 15)), after_name(42)),
        (1, F.concat(F.left("m", F.lit(4)), F.lit("!"), F.left(hexed, F.lit(3)), F.lit(".@"), F.substring("m", 10, 5), F.lit("#"), F.right("m", F.lit(2))), after_name(44)),
        (1, F.concat(secret_name, chosen(46, "=", ":"), name(47), name(48), name(49), name(50), name(51)), pick(52)),
        (1, F.concat(secret_name, chosen(53, "=", ":"), name(54), F.substring(F.regexp_replace("d", "[a-f]", ""), 2, 3)), pick(55)),
        (0, name(56), after_name(57)),
        (0, chosen(59, *idle), after_name(60)),
        (0, F.concat(secret_name, chosen(62, "=", ":"), chosen(63, *idle)), pick(64)),
        (0, F.concat(secret_name, F.lit("="), name(65)), pick(66)),
    ]
    planted = [F.struct(F.concat_ws(" ", before, word, pick(40)).alias("text"), F.lit(y).alias("label")) for y, word, before in forms]
    made = near.select("doc_id", F.explode(F.array(*planted)).alias("p")).select("doc_id", "p.text", "p.label")
    found = candidates(made.withColumn("doc_id", F.col("doc_id") * 2 + F.col("label")))
    return found.withColumn("label", F.abs(F.col("doc_id") % 2).cast("int"))
