"""Secret scan: candidate strings judged by a random forest, in built-in functions only.

Candidates are long unbroken runs of key characters, and values of any length and
characters that are assigned to a keyword. The forest sees their length,
the transitions between kinds of characters, how much of them dictionary words
cover, whether they stand in a path or address, and the words around them. It
learns from labelled findings and removes the false positives among the candidates:
long words, card numbers, rulers, names of files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.session import cut_lineage

#: A run of key characters, and the cheap test for a text that holds one.
RUN = r"[A-Za-z0-9+/_-]{16,}"
BLANKS = r"[\x20\x09-\x0D]+"
KEYWORDS = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api_?key|access_?key|private_?key|credential|auth|bearer)"
#: A keyword and what assigns a value to it, up to the value's opening quote: ``key = ``, ``"key": "``, ``key: Bearer ``.
ASSIGNS = (
    r"(?i:(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth(?:orization)?|bearer)"
    r"(?:s|[_-][a-z0-9_-]{1,30})?[\"']?\s*[=:]{1,3}>?(?!//)\s*(?:(?:bearer|basic|token)\s+)?)"
)
HEAD = rf"(?:{ASSIGNS}|(?i:\bbearer\s+(?=[\"']?\S{{16}})))[\"']?"
#: The value: up to its closing quote, or without quotes the non-blanks but closing punctuation.
VALUE = (
    r"""(?:(?<=")(?!")[^"\\\r\n]*+(?:\\.[^"\\\r\n]*+)*+(?=")|(?<=')(?!')[^'\\\r\n]*+(?:\\.[^'\\\r\n]*+)*+(?=')"""
    r"""|(?!["'])\S*[^\s"',;.)\]}>])"""
)
#: Fixed shapes of issued access keys.
ISSUED = (
    r"^((AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,}|npm_[A-Za-z0-9]{36}"
    r"|[rs]k_(live|test)_[A-Za-z0-9]{10,}|xox[abeoprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{30,})$"
)
#: What is surely no secret: plain words, numbers and rulers, and what stands for a value.
PLAIN = r"^([A-Z]?[a-z]+|[A-Z]+|[0-9+/_-]+)([/_-]+([A-Z]?[a-z]+|[A-Z]+|[0-9]+))*[/_-]*$"
STANDS_FOR = r"(?i)^(null|none|nil|true|false|string|str|required|optional|undefined|\*+|\$?\{+[^{}]*\}*|<[^<>]*|\[secret)$"

FEATURES = [
    "length", "digits", "upper", "lower", "symbols", "vowels", "variety", "hex", "kind_changes", "case_changes",
    "consonant_runs", "other", "coverage", "in_path", "in_address", "extension", "keyword_near", "assigned", "quoted", "word_before", "word_after",
]


@dataclass(frozen=True)
class Forest:
    """Bounds of the training sample and of the dictionary, and the shape of the forest."""

    rows_per_label: int = 10_000
    dictionary: int = 5_000
    trees: int = 20
    depth: int = 6


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run of key characters and per value assigned to a keyword.

    Columns: id, place of the (first) word, run, value, surroundings. ``run`` numbers the
    runs of a word from 0; assigned values that are no run have larger numbers.
    """
    return _runs(docs, id_col, text_col).unionByName(_assigned(docs, id_col, text_col))


def _assigned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Values assigned to a keyword, but those that are runs of key characters."""
    text = F.col(text_col)
    rows = docs.where(text.rlike(HEAD + VALUE)).select(
        F.col(id_col).alias("id"),
        F.split(text_col, BLANKS).alias("_words"),
        F.regexp_extract_all(text_col, F.lit(HEAD + VALUE), 0).alias("_hits"),
        F.split(text_col, HEAD + VALUE, -1).alias("_between"),
    )
    # no match begins or ends with a blank, so the blanks between words add up
    blanks = F.transform("_between", lambda piece, i: F.regexp_count(piece, F.lit(BLANKS)) + F.when(i > 0, F.regexp_count(F.get("_hits", i - 1), F.lit(BLANKS))).otherwise(0))
    spots = rows.select("*", blanks.alias("_blanks")).select(
        "id", "_words", F.explode(F.transform("_hits", lambda hit, i: F.struct(
            i.alias("i"),
            F.regexp_replace(hit, "^" + HEAD + "(?=" + VALUE + ")", "").alias("value"),
            (F.aggregate(F.slice("_blanks", 1, i + 1), F.lit(0), lambda a, b: a + b) + F.regexp_count(hit, F.lit(BLANKS))).alias("upto"),
            F.regexp_extract(F.get("_between", i + 1), r"^\S*", 0).alias("right"),
        ))).alias("s")
    ).select("id", "_words", "s.*")
    spots = spots.where(~F.col("value").rlike(f"^{RUN}$")).withColumn("place", F.col("upto") - F.regexp_count("value", F.lit(BLANKS)))
    first = F.regexp_extract("value", r"^\S*", 0)
    word = F.get("_words", F.col("place"))
    behind = F.length(first) + F.when(F.col("upto") == F.col("place"), F.length("right")).otherwise(0)
    return spots.select(
        "id", "place", (F.regexp_count(word, F.lit(RUN)) + F.col("i")).alias("run"), "value",
        F.substring(word, F.lit(1), F.length(word) - behind).alias("left"),
        "right",
        *[F.coalesce(F.get("_words", F.col(at) + step), F.lit("")).alias(name) for name, at, step in (("before", "place", -1), ("before2", "place", -2), ("after", "upto", 1))],
    )


def _runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.where(F.col(text_col).rlike(RUN)).select(F.col(id_col).alias("id"), F.split(text_col, BLANKS).alias("_words"))
    # the words become a column of the scan, so that no element test splits the text again
    found = F.filter(F.sequence(F.lit(0), F.size("_words") - 1), lambda i: F.get(F.col("_words"), i).rlike(RUN))
    around = F.transform(
        found,
        lambda i: F.struct(
            i.alias("place"),
            F.get(F.col("_words"), i).alias("word"),
            F.coalesce(F.get(F.col("_words"), i - 1), F.lit("")).alias("before"),
            F.coalesce(F.get(F.col("_words"), i - 2), F.lit("")).alias("before2"),
            F.coalesce(F.get(F.col("_words"), i + 1), F.lit("")).alias("after"),
        ),
    )
    spots = rows.select("id", F.explode(around).alias("s")).select("id", "s.*")
    runs = spots.select("*", F.posexplode(F.regexp_extract_all("word", F.lit(RUN), 0)).alias("run", "value"))
    return runs.select(
        "id", "place", "run", "value",
        F.expr("substring(word, 1, locate(value, word) - 1)").alias("left"),
        F.expr("substring(word, locate(value, word) + length(value))").alias("right"),
        "before", "before2", "after",
    )


def dictionary(docs: DataFrame, how: Forest = Forest(), text_col: str = "text") -> DataFrame:
    """The commonest plain words of 3 to 8 letters of all texts; ties by the word."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(r"\b[a-z]{3,8}\b"), 0)).alias("entry"))
    counted = words.groupBy("entry").count()
    return counted.orderBy(F.desc("count"), "entry").limit(how.dictionary).select("entry")


def _coverage(values: DataFrame, entries: DataFrame) -> DataFrame:
    """``(value, coverage)``: share of characters under dictionary words, per distinct value."""
    text = F.lower("value")
    last = F.length("value")
    pieces = (
        values.select("value").where(last >= 3).distinct()
        .select("value", F.explode(F.sequence(F.lit(1), last - 2)).alias("from"))
        .select("value", "from", F.explode(F.sequence(F.lit(3), F.lit(8))).alias("size"))
        .where(F.col("from") + F.col("size") - 1 <= last)
        .select("value", "from", "size", F.substring(text, F.col("from"), F.col("size")).alias("entry"))
        .where(F.col("entry").rlike("^[a-z]+$"))
    )
    met = pieces.join(entries, "entry").select("value", F.explode(F.expr("sequence(from, from + size - 1)")).alias("at"))
    return met.distinct().groupBy("value").agg((F.count("at") / F.first(last)).alias("coverage"))


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.length("value")


def _flag(test: Column) -> Column:
    return F.when(test, 1.0).otherwise(0.0)


def with_features(found: DataFrame, entries: DataFrame) -> DataFrame:
    """Candidates with the columns of ``FEATURES``."""
    near = F.concat_ws(" ", "before2", "before", "left")
    joined = found.join(_coverage(found, entries), "value", "left").withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))
    return joined.select(
        *found.columns,
        F.length("value").cast("double").alias("length"),
        _share("[0-9]").alias("digits"),
        _share("[A-Z]").alias("upper"),
        _share("[a-z]").alias("lower"),
        _share("[+/_-]").alias("symbols"),
        _share("(?i)[aeiou]").alias("vowels"),
        (F.size(F.array_distinct(F.split("value", ""))) / F.length("value")).alias("variety"),
        _flag(F.col("value").rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hex"),
        _share("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]").alias("kind_changes"),
        _share("(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]").alias("case_changes"),
        _share("(?i)[bcdfghjklmnpqrstvwxz]{4,}").alias("consonant_runs"),
        _share("[^A-Za-z0-9+/_-]").alias("other"),
        "coverage",
        _flag(F.col("value").contains("/") | F.col("left").endswith("/") | F.col("right").startswith("/")).alias("in_path"),
        _flag(F.col("left").contains("://") | F.col("left").contains("@")).alias("in_address"),
        _flag(F.col("right").rlike(r"^\.[A-Za-z]{1,4}\b")).alias("extension"),
        _flag(near.rlike(KEYWORDS)).alias("keyword_near"),
        _flag(F.concat_ws("", "before", "left").rlike("[=:][\"']?$")).alias("assigned"),
        _flag(F.col("left").rlike("[\"']$") & F.col("right").rlike("^[\"']")).alias("quoted"),
        F.length("before").cast("double").alias("word_before"),
        F.length("after").cast("double").alias("word_after"),
    )


def label_by_rule(found: DataFrame) -> DataFrame:
    """Labels for findings where none are given: 1 or 0 where the rule is sure, else null.

    1 are issued keys and values with a digit that are assigned to a keyword; 0 are
    words, numbers, rulers and paths without a keyword near, and what only stands for
    a value. The forest carries the rule over to what it leaves open.
    """
    near = F.concat_ws(" ", "before2", "before", "left")
    value = F.col("value")
    path = F.col("left").contains("://") | (value.contains("/") & F.col("right").rlike(r"^\.[A-Za-z]{1,4}\b"))
    stands_for = value.rlike(STANDS_FOR)
    sure = value.rlike(ISSUED) | (near.rlike(ASSIGNS + "[\"']?$") & value.rlike("[0-9]") & ~stands_for)
    wrong = stands_for | (~near.rlike(KEYWORDS) & (value.rlike(PLAIN) | path))
    return found.withColumn("label", F.when(sure, 1.0).when(wrong, 0.0))


def train(labelled: DataFrame, how: Forest = Forest()) -> RandomForestClassificationModel | float:
    """Forest from ``FEATURES`` and ``label`` (0 or 1; nulls are passed over).

    At most ``rows_per_label`` rows of each label are used, taken by a hash of the
    value and its place. With one label only, that label is the answer for all
    (0 without any rows).
    """
    known = labelled.where("label in (0, 1)").select(*FEATURES, "label", F.xxhash64("id", "place", "run", "value").alias("_h"))
    parts = [known.where(F.col("label") == label).orderBy("_h").limit(how.rows_per_label) for label in (0, 1)]
    sample = cut_lineage(parts[0].union(parts[1]).drop("_h"))
    present = [row.label for row in sample.groupBy("label").count().orderBy("label").collect()]
    if len(present) < 2:
        return present[0] if present else 0.0
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(sample)
    forest = RandomForestClassifier(featuresCol="_features", labelCol="label", numTrees=how.trees, maxDepth=how.depth, seed=1)
    return forest.fit(vectors)


def judge(featured: DataFrame, model: RandomForestClassificationModel | float) -> DataFrame:
    """Candidates with ``probability`` and ``is_secret`` (0.5 or more)."""
    if isinstance(model, float):
        judged = featured.withColumn("probability", F.lit(model))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(featured)
        model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_p")
        judged = model.transform(vectors).withColumn("probability", vector_to_array("_p")[1])
    kept = [c for c in featured.columns if c not in FEATURES and c != "label"]
    return judged.select(*kept, "probability", (F.col("probability") >= 0.5).alias("is_secret"))


def scan(docs: DataFrame, held_out: Column | None = None, how: Forest = Forest(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every candidate of every whole text with the forest's verdict.

    Columns: id, place (of the first word, from 0), run, value, left, right, before, before2,
    after, probability, is_secret. Rows under ``held_out`` are not learned from. Null
    and blank texts have no candidates; null and repeated ids give rows as they are;
    an empty table gives no rows; other columns are not read.
    """
    learn = F.lit(True) if held_out is None else ~held_out
    marked = docs.select(F.col(id_col), F.col(text_col), learn.alias("_learn"))
    found = candidates(marked.select(F.struct(id_col, "_learn").alias("id"), text_col), "id", text_col)
    featured = cut_lineage(label_by_rule(with_features(found, dictionary(docs, how, text_col))))
    model = train(featured.where("id._learn"), how)
    judged = judge(featured, model)
    return judged.select(F.col(f"id.{id_col}").alias(id_col), *[c for c in judged.columns if c != "id"])


def redact(docs: DataFrame, secrets: DataFrame, mask: str = "[secret]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the secret values of each id replaced by ``mask``; all columns and rows kept.

    Values of 16 or more characters are replaced wherever they stand, shorter ones, which
    may be common words, where they are assigned to a keyword.
    """
    values = F.array_sort(F.collect_set("value"), lambda a, b: F.length(b) - F.length(a))
    per_doc = secrets.where("is_secret").groupBy(F.col(id_col).alias("_id")).agg(values.alias("_values"))
    joined = docs.join(per_doc, F.col(id_col).eqNullSafe(F.col("_id")), "left")
    kept_mask = "$1" + mask.replace("\\", "\\\\").replace("$", "\\$")

    def masked_value(text: Column, value: Column) -> Column:
        literal = F.concat(F.lit("\\Q"), F.replace(value, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
        pattern = F.concat(F.lit(f"({HEAD})"), literal, F.lit("(?=[\"',;.)\\]}>]*(?:\\s|$)|[\"'])"))
        return F.when(F.length(value) >= 16, F.replace(text, value, F.lit(mask))).otherwise(F.regexp_replace(text, pattern, F.lit(kept_mask)))

    masked = F.aggregate("_values", F.col(text_col), masked_value)
    text = F.when(F.col("_values").isNotNull(), masked).otherwise(F.col(text_col))
    return joined.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])
