"""Secret scan whose false positives a random forest removes; DataFrame functions and Spark ML only.

A candidate is a run of at least 20 token characters, or any value of at least
8 characters that is assigned to a credential's name (``password = "..."``); a
quoted value may hold spaces and is one candidate up to its quote, however long. Its features are its length, its shares of character classes and the transitions between them, its
entropy, how much of it the corpus's own frequent words cover, path-like
surroundings, and the words beside it. The forest is trained on labelled
findings: ``labelled`` holds findings (the columns of ``findings``) and a
``label``, 1.0 for a secret and 0.0 for none. ``weak_labels`` gives them where
no labels are at hand: assignments of a quoted random string to a credential's
name are secrets; runs of letters alone, unquoted single words and digests
after a word such as ``commit`` are not, the rest stays unlabelled. A forest
trained on those can only carry the rules over to findings that they leave
open; ``measure`` tells how well, on findings whose strings it has not seen.

The forest sees at most ``TRAIN`` labelled findings of each class, those with
the least hashes; every finding is scored. Null and empty texts have no
candidates. A null doc_id and repeated rows are scanned like others. Where the
labelled findings lack a class, no forest can be fitted and the rules decide:
sure secrets are reported, and so are unquoted assignments of a long random run.
Findings that tie with ``LEAST_PROBABILITY`` count as secrets. Of words that are
equally frequent those first by code point enter the dictionary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import least_hashes, stash

RUN = r"[A-Za-z0-9+/_=-]{20,}"
_NAMES = r"token|secret|passw|pwd|api.?key|auth|bearer|credential|private|access"
#: A name with a credential's in it, = or : and a quote, up to where the value begins. The name may begin inside a run, which then ends before the value.
ASSIGNMENT = rf"(?<![\w.+/=-])(?:[\w.-]{{0,64}}?|[A-Za-z0-9+/_.=-]{{0,19}}?)(?i:{_NAMES})[\w.-]{{0,24}}[\"'`\])]{{0,2}}[ \t]{{0,8}}[=:]{{1,2}}>?\s{{0,8}}(?i:(?:bearer|basic)[ \t]+)?[\"'`]?"
#: All up to the closing quote, or all up to white space, a quote or the next parameter of an address, without the punctuation that follows.
VALUE = r"(?:(?<=\")[^\"\r\n]{8,}+(?=\")|(?<=')[^'\r\n]{8,}+(?=')|(?<=`)[^`\r\n]{8,}+(?=`)|[^\s\"'`]{8,}?(?=[.,;:)\]}>]*(?:&[\w.-]+=|[\s\"'`]|\z)))"
CANDIDATE = f"({ASSIGNMENT})({VALUE})|({RUN})"
TRAIN, TREES, DEPTH, LEAST_PROBABILITY, MASK = 10_000, 40, 8, 0.5, "[SECRET]"
#: Words of the dictionary, and the letters they have.
WORDS, LETTERS = 2000, "[a-z]{4,12}"
CREDENTIAL = rf"(?i)({_NAMES})"
DIGEST = r"(?i)(commit|revision|sha\d*|md5|checksum|digest|etag|hash)\W*$"
FEATURES = ("f_length", "f_digit", "f_upper", "f_lower", "f_symbol", "f_turns", "f_distinct", "f_entropy", "f_vowel", "f_words", "f_slashes", "f_path", "f_example", "f_credential", "f_digest", "f_assigned", "f_quoted", "f_alone")


def _measured(c: Column, left: Column, right: Column, source: Column, dictionary: tuple[str, ...]) -> dict[str, Column]:
    n = F.length(c).cast("double")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    as_double = lambda flag: flag.cast("double")
    chars = F.split(c, "")
    count = lambda x: (F.length(c) - F.length(F.replace(c, x, F.lit("")))) / n
    entropy = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, x: F.when(F.length(x) == 0, s).otherwise(s - count(x) * F.log2(count(x))))
    return {
        "f_length": F.log2(n),
        "f_digit": share("[0-9]"), "f_upper": share("[A-Z]"), "f_lower": share("[a-z]"), "f_symbol": share("[^A-Za-z0-9]"),
        "f_turns": share("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "f_distinct": F.size(F.array_distinct(chars)) / n,
        "f_entropy": entropy,
        "f_vowel": share("[aeiouAEIOU]"),
        "f_words": 1 - F.length(F.regexp_replace(F.lower(c), "|".join(sorted(dictionary, key=lambda w: (-len(w), w))) or r"(?!)", "")) / n,
        "f_slashes": share("/"),
        "f_path": as_double(left.rlike(r"(?i)(https?:|www\.|[\w.-]+[/\\])\S*$")),
        "f_example": as_double(F.coalesce(source, F.lit("")).rlike("(?i)(test|example|sample|fixture|mock)")),
        "f_credential": as_double(left.rlike(CREDENTIAL)),
        "f_digest": as_double(left.rlike(DIGEST)),
        "f_assigned": as_double(left.rlike(r"(?i)[=:]>?\s*((bearer|basic)\s+)?[\"'`]?$")),
        "f_quoted": as_double(left.rlike(r"[\"'`]$") & right.rlike(r"^[\"'`]")),
        "f_alone": as_double((F.length(left) == 0) | left.rlike(r"\s$")),
    }


def dictionary(docs: DataFrame, most: int = WORDS) -> tuple[str, ...]:
    """The ``most`` most frequent words of all texts: as many strings reach the driver."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(rf"(?<![a-z]){LETTERS}(?![a-z])"), F.lit(0))).alias("w"))
    top = words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(most)
    return tuple(r["w"] for r in top.collect())


def findings(docs: DataFrame, words: tuple[str, ...] = ()) -> DataFrame:
    """Every candidate: doc_id, source, number in its text, start (characters), the candidate, its sides and features by the dictionary ``words``."""
    text = F.coalesce("text", F.lit(""))
    cut = docs.select("doc_id", "source", F.xxhash64(text).alias("text_hash"), text.alias("_t")).where(F.col("_t").rlike(CANDIDATE))
    all_of = lambda k: F.regexp_extract_all("_t", F.lit(CANDIDATE), F.lit(k))
    cut = cut.select("doc_id", "source", "text_hash", all_of(1).alias("_p"), all_of(2).alias("_v"), all_of(3).alias("_c"), F.split("_t", CANDIDATE, -1).alias("_g"))
    cut = cut.withColumn("_row", F.monotonically_increasing_id())
    # an assignment's name belongs to the text before its value
    before = lambda i: F.concat(F.get("_g", i), F.coalesce(F.get("_p", i), F.lit("")))
    # sides only, so that exploding does not multiply whole texts
    each = F.transform("_c", lambda c, i: F.struct(F.concat(F.get("_v", i), c).alias("candidate"), F.right(before(i), F.lit(64)).alias("left"), F.left(before(i + 1), F.lit(32)).alias("right"), F.length(before(i)).alias("gap")))
    rows = cut.select("doc_id", "source", "text_hash", "_row", F.posexplode(each).alias("no", "x")).select("doc_id", "source", "text_hash", "_row", "no", "x.*")
    w = Window.partitionBy("_row").orderBy("no")
    start = F.sum(F.col("gap") + F.length("candidate")).over(w) - F.length("candidate")
    rows = rows.withColumn("start", start).drop("gap", "_row")
    return rows.withColumns(_measured(F.col("candidate"), F.col("left"), F.col("right"), F.col("source"), words))


def _random_assigned() -> Column:
    """Whether a finding is a random string assigned to a credential's name; less entropy is asked of a short one, which cannot reach it."""
    return (F.col("f_credential") == 1) & (F.col("f_assigned") == 1) & (F.col("f_digit") > 0.1) & (F.col("f_entropy") > F.least(F.lit(3.0), 0.8 * F.col("f_length"))) & ~F.col("candidate").rlike(r"\s")


def weak_labels(found: DataFrame) -> DataFrame:
    """Findings with a sure label: 1.0 for secrets, 0.0 for others."""
    sure = _random_assigned() & (F.col("f_quoted") == 1)
    not_one = (F.col("f_digit") == 0) & (F.col("f_credential") == 0) | (F.col("f_digest") == 1) & (F.col("f_credential") == 0)
    not_one |= (F.col("f_quoted") == 0) & F.col("candidate").rlike("^[A-Za-z]?[a-z]+$")
    return found.withColumn("label", F.when(sure, 1.0).when(not_one, 0.0)).where("label IS NOT NULL")


def train(labelled: DataFrame, most: int = TRAIN):
    """A forest fitted to at most ``most`` labelled findings of each class, or None if a class is missing."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    labelled = labelled.select("candidate", "left", "doc_id", "no", *FEATURES, "label").withColumn("_h", F.xxhash64("candidate", "left", "doc_id", "no"))
    labelled = least_hashes(labelled, "label", "_h", most, "secrets")
    order = Window.partitionBy("label").orderBy("_h", "doc_id", "no")
    some = labelled.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= most).select(*FEATURES, "label", "_k")
    some = stash(some.orderBy("label", "_k").coalesce(1), "secrets-train")
    if some.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(some)
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=17).fit(rows)


def score(found: DataFrame, model) -> DataFrame:
    """Findings with ``probability`` and ``is_secret``; by the rules of ``weak_labels`` where there is no model."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    if model is None:
        by_rule = F.when(F.col("f_quoted") == 1, 1.0).when(F.col("candidate").rlike(r"^[A-Za-z0-9+/_=-]{20,}$"), LEAST_PROBABILITY)
        out = found.withColumn("probability", F.when(_random_assigned(), by_rule).otherwise(0.0)).fillna(0.0, ["probability"])
        return out.withColumn("is_secret", F.col("probability") >= LEAST_PROBABILITY)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
    out = model.transform(rows).withColumn("probability", vector_to_array("probability")[1])
    return out.withColumn("is_secret", F.col("probability") >= LEAST_PROBABILITY).drop("features", "rawPrediction", "prediction")


def measure(labelled: DataFrame, every: int = 5) -> dict[str, float]:
    """Precision and recall over every ``every``-th labelled string, by a forest that was trained on the others."""
    aside = F.pmod(F.xxhash64("candidate"), F.lit(every)) == 0
    scored = score(labelled.where(aside), train(labelled.where(~aside)))
    n, hit, said, true = scored.agg(
        F.count("*"), F.count_if(F.col("is_secret") & (F.col("label") == 1)), F.count_if("is_secret"), F.count_if(F.col("label") == 1)
    ).first()
    return {"n": n, "precision": hit / said if said else 1.0, "recall": hit / true if true else 1.0}


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """All findings of ``docs(doc_id, text, source)``, scored."""
    found = stash(findings(docs, dictionary(docs)), "secrets-findings")
    return score(found, train(weak_labels(found) if labelled is None else labelled))


def redact(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with every secret in its texts replaced; columns stay, ``n_chars`` follows the text."""
    hit = scan(docs, labelled).where("is_secret").groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("candidate"), lambda a, b: F.length(b) - F.length(a)).alias("secrets"))
    hit = stash(hit, "secrets-hits").select(F.col("doc_id").alias("id"), "text_hash", "secrets")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))  # the columns may have any names
    out = rows.join(hit, F.col("doc.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64(F.coalesce("doc.text", F.lit(""))) == F.col("text_hash")), "left")
    clean = F.aggregate(F.coalesce("secrets", F.array().cast("array<string>")), F.col("doc.text"), lambda t, s: F.replace(t, s, F.lit(MASK)))
    changed = {"text": clean, "n_chars": F.when(F.col("secrets").isNotNull(), F.length(clean).cast("long")).otherwise(F.col("doc.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*(changed.get(c, F.col("doc")[c]).alias(c) for c in docs.columns))
