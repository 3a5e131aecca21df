"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is a run of at least ``SHORTEST`` key characters with a digit (with its
base64 padding), the value of at least ``SHORTEST_VALUE`` characters given to a
credential's name (``password=...``), or the password of an address (``://user:...@``); a word may have several, and each is a row.
It is described by its
length, the shares of its kinds of characters, the transitions between kinds,
the variety of characters, how much of it is covered by dictionary words (the
most frequent words of the corpus), whether it is part of a path, address or
number, and by its neighbouring words. A random forest, trained from labelled
findings, gives the probability that it is a secret; below ``THRESHOLD`` it is
dropped as a false positive.

Labelled findings are a table of the candidates' columns with ``label`` 0 or 1.
Where none are given, ``seed_labels`` marks the clear cases: keys of a known
form and values of credential names as 1; dates, numbers, addresses, paths and
runs of words as 0; the rest is left to the forest. Rows for the fit are a bounded
sample, ``FIT_ROWS`` of each label, never from held-out documents.

Candidates are found line by line by expressions, so only the few lines that
have one are split to words; dictionary look-ups pre-aggregate. Nothing is a
Python function and no text is shuffled. The dictionary counts all documents'
words; it is bounded by its size, not by the corpus.

Defined cases: null and empty texts have no candidates; a document without any
has no row; an empty table, or one without labels of both kinds, gives the
candidates with probability null and ``kept`` true (nothing is removed on no
evidence). Repeated rows give repeated candidates. Values, names and words are
whole however long they are, and a long line takes time in proportion to its length.
Extra columns are not read.
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepulse.llm.common import class_sample, filled, held_out
from tablepulse.session import checkpointed

#: characters of a run of key characters, and of a value given to a credential's name, at least
SHORTEST, SHORTEST_VALUE = 12, 6
_KEY = r"A-Za-z0-9+/_\-"
#: a key id, or a run of key characters with a digit
_RUN = rf"(?:AKIA|ASIA)[0-9A-Z]{{16}}|(?<![{_KEY}])(?=[A-Za-z+/_\-]*+[0-9])[{_KEY}]{{{SHORTEST},}}"
#: what a key may be written together with: no white space, quotes, brackets, signs and separators
_PART = r"[\x21-\x7E\p{IsLatin}&&[^\"'`:=,;&?<>()\[\]{}|]]"
#: a part that has a key, with the padding of base64; a sign that gives a value is no padding
KEY = rf"(?<!{_PART})(?={_PART}*?(?:{_RUN})){_PART}++(?:={{1,2}}(?![=\"'`]?{_PART}))?"
#: a credential's name and the sign of assignment, with or without white space at its sides
_NAMED = r"(?i:passw(?:or)?d|passwd|secret|token|api_?key|credential)s?\\*+[\"'`]?\]?\s*+[:=]{1,3}>?\s*+"
#: a value ends at white space, a quote, or a separator that another assignment follows
_VALUE = rf"(?![{{]*+{_NAMED})(?=[^\s\"'`]{{{SHORTEST_VALUE}}})([^\s\"'`&;,]*+(?:[&;,](?![\w.\-]++[\"'`]?\]?\s*+[:=])[^\s\"'`&;,]*+)*+)"
#: a quoted value is all between its quotes
_QUOTED = rf"[(\[]*+(?:\"(?=(?:[^\"\\]|\\.){{{SHORTEST_VALUE}}})([^\"\\]*+(?:\\.[^\"\\]*+)*+)\"|'(?=(?:[^'\\]|\\.){{{SHORTEST_VALUE}}})([^'\\]*+(?:\\.[^'\\]*+)*+)'|`([^`]{{{SHORTEST_VALUE},}}+)`)"
#: the value given to a credential's name, or the password of an address
ASSIGNED = rf"{_NAMED}(?:{_QUOTED}|\\*[\"'`]?[(\[<]*{_VALUE}[\"'`]?)"
_LOGIN = r"://[^\s:/@\"'`]*+:([^\s/\"'`]+)@"
#: a line's words: each ends at white space, or after the value that it gives to a credential
_WORD = rf"(\S*?)(?:({ASSIGNED})|{_LOGIN})|\S+"
CANDIDATE = rf"{_RUN}|{ASSIGNED}|{_LOGIN}"
CREDENTIAL = r"(?i)(passw(or)?d|passwd|secret|token|api_?key|credential|auth)"
#: forms of keys that are public knowledge
KEY_FORM = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^AIza[0-9A-Za-z_\-]{35}$|^sk_live_[0-9a-zA-Z]{24,}$"
PLAIN_FORM = r"^[0-9]+$|^[0-9]{1,4}([-/.:T][0-9]{1,4})+$|^\+?[0-9][0-9\- ]+$"
DICTIONARY_WORDS = 2000
FIT_ROWS = 4000
TREES, DEPTH, SEED = 30, 6, 7
THRESHOLD = 0.5
FEATURES = [
    "f_length", "f_digits", "f_upper", "f_lower", "f_other", "f_changes", "f_variety", "f_hex", "f_covered",
    "f_path", "f_address", "f_number", "f_assigned", "f_quoted", "f_named_before", "f_named_after", "f_before", "f_after",
]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, word_no, word (as written), secret (the value), name (what it is given to), before, after:
    one row per candidate, of which a word may have several."""
    lines = docs.select("doc_id", F.posexplode(F.split(filled("text"), "\n", -1)).alias("line_no", "line")).where(F.col("line").rlike(CANDIDATE))
    # other names may stand apart from the sign that gives them a quoted value, too (a run of spaces is tried from its start only)
    lines = lines.withColumn("line", F.regexp_replace("line", r"(?<!\s)\s*+([:=])\s++(?=[\"'])", "$1"))
    line = F.col("line")
    fields = ["w", "head", "given", "double", "single", "back", "value", "login"]
    groups = {name: F.regexp_extract_all(line, F.lit(_WORD), F.lit(k)) for k, name in enumerate(fields)}
    # as if split at white space, a line that begins with it has an empty first word
    indent = F.when(line.rlike(r"^\s"), 1).otherwise(0)
    words = lines.select("doc_id", "line_no", indent.alias("_indent"), *(g.alias(n) for n, g in groups.items()))
    words = words.withColumn("_z", F.arrays_zip(*fields))
    words = words.select("doc_id", "line_no", "_indent", "w", F.posexplode("_z").alias("at", "_z"))
    found = words.select("doc_id", "line_no", "_indent", "at", "_z.*", F.when(F.col("at") > 0, F.get("w", F.col("at") - 1)).otherwise("").alias("before"), F.coalesce(F.get("w", F.col("at") + 1), F.lit("")).alias("after"))
    found = found.withColumn("_whole", F.concat("double", "single", "back"))
    # words with a sign of assignment to a credential, or a login, have their value and the keys before it
    found = found.withColumn("_rest", F.when((F.col("given") != "") | (F.col("login") != ""), F.col("head")).otherwise(F.col("w")))
    found = found.where((F.col("_whole") != "") | (F.length("value") >= 6) | (F.col("login") != "") | F.col("_rest").rlike(_RUN))
    found = found.withColumns({"_gaps": F.split("_rest", KEY, -1), "_keys": F.regexp_extract_all("_rest", F.lit(KEY), F.lit(0))})
    piece = "struct<word:string,secret:string,name:string,assigned:boolean,quoted:boolean>"

    def key(match: Column, i: Column) -> Column:
        # what stands around a key, back to the key before and on to the key after it
        left = F.concat(F.coalesce(F.get("_keys", i - 1), F.lit("")), F.get("_gaps", i))
        right = F.concat(F.get("_gaps", i + 1), F.coalesce(F.get("_keys", i + 1), F.lit("")))
        # runs are tried from their start only, so that long ones take time in proportion
        around = r"[^\s\"'`,;&{}<>()\[\]|]"
        word = F.concat(F.regexp_extract(left, f"(?<!{around}){around}*+$", 0), match, F.regexp_extract(right, f"^{around}*+", 0))
        name = F.regexp_extract(left, r"(?<![\w.\-])(?:([\w.\-]++)|(?<![:=\\]))\\*+[\"'`]?+\]?+[:=]++>?[\"'`(\[<{\\]*+$", 1)
        quoted = left.rlike("[\"'`]$") | right.rlike("^[\"'`]")
        secret = F.regexp_replace(match, r"[.!%*#$]+$", "")
        return F.struct(word, secret, name, left.rlike(r"[:=]>?[\"'`(\[<{\\]*$"), quoted).cast(piece)

    # quotes show where a value ends, else closing brackets and the sentence's signs are not its own
    value = F.when(F.col("_whole") != "", F.col("_whole")).otherwise(F.regexp_replace("value", r"[.,;:?)\]}>\\]+$", ""))
    inner = F.regexp_extract(value, _LOGIN, 1)
    value = F.when(inner != "", inner).otherwise(value)
    # the pattern begins at the credential's word: what the name has before it is in the head
    named = F.concat(F.regexp_extract("head", r"(?<![\w.\-])[\w.\-]*+$", 0), F.regexp_extract("given", r"^[\w.\-]*+", 0))
    own = F.when(F.col("login") != "", F.struct("login", "login", F.lit("password"), F.lit(True), F.lit(False)).cast(piece)).when(
        (F.col("_whole") != "") | (F.length("value") >= 6),
        F.struct(value, value, named, F.lit(True), F.col("given").rlike("[\"'`]")).cast(piece),
    )
    pieces = F.concat(F.transform("_keys", key), F.filter(F.array(own), lambda x: x.isNotNull()))
    found = found.select("doc_id", "line_no", (F.col("at") + F.col("_indent")).alias("word_no"), "before", "after", F.explode(pieces).alias("_p"))
    return found.select("doc_id", "line_no", "word_no", "_p.*", "before", "after").where(F.length("secret") > 0)


def dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent words of 3 or more letters in all documents, lower case: at most ``words``."""
    each = docs.select(F.explode(F.split(F.lower(filled("text")), r"[^\p{L}]+")).alias("entry"))
    counted = each.where(F.length("entry") >= 3).groupBy("entry").agg(F.count(F.lit(1)).alias("n"))
    return [r["entry"] for r in counted.orderBy(F.desc("n"), "entry").limit(words).collect()]


def _share(pattern: str) -> Column:
    return F.regexp_count("secret", F.lit(pattern)) / F.length("secret")


def features(found: DataFrame, words: list[str]) -> DataFrame:
    """``found`` with the numbers that describe each candidate; ``words`` is the dictionary."""
    known = F.from_json(F.lit(json.dumps(words)), "array<string>")
    parts = F.array_distinct(F.filter(F.split(F.lower("secret"), r"[^\p{L}]+"), lambda p: F.length(p) >= 3))
    covered = F.aggregate(F.array_intersect(parts, known), F.lit(0), lambda n, p: n + F.length(p))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace("secret", "[0-9]", "0"), r"\p{Lu}", "A"), r"\p{Ll}", "a")
    changes = F.regexp_count(kinds, F.lit(r"0(?=[^0])|A(?=[^A])|a(?=[^a])"))
    return found.withColumns(
        {
            "f_length": F.length("secret").cast("double"),
            "f_digits": _share("[0-9]"),
            "f_upper": _share(r"\p{Lu}"),
            "f_lower": _share(r"\p{Ll}"),
            "f_other": _share(r"[^0-9\p{L}]"),
            "f_changes": changes / F.length("secret"),
            "f_variety": F.size(F.array_distinct(F.split("secret", ""))) / F.length("secret"),
            "f_hex": F.col("secret").rlike("^[0-9a-fA-F]+$").cast("double"),
            "f_covered": covered / F.length("secret"),
            "f_path": F.col("word").rlike(r"://|^[./~]|/[^/]+/|\.[a-z]{2,4}$").cast("double"),
            "f_address": F.col("word").rlike("@|^www").cast("double"),
            "f_number": F.col("secret").rlike(PLAIN_FORM).cast("double"),
            "f_assigned": F.col("assigned").cast("double"),
            "f_quoted": F.col("quoted").cast("double"),
            "f_named_before": F.concat_ws(" ", "before", "name").rlike(CREDENTIAL).cast("double"),
            "f_named_after": F.col("after").rlike(CREDENTIAL).cast("double"),
            "f_before": F.length("before").cast("double"),
            "f_after": F.length("after").cast("double"),
        }
    )


def seed_labels(described: DataFrame) -> DataFrame:
    """The clear cases, with ``label``."""
    form = F.col("secret").rlike(KEY_FORM)
    named = (F.col("f_named_before") == 1) & (F.col("f_digits") > 0) & (F.col("f_length") >= 8)
    plain = (F.col("f_number") == 1) | (F.col("f_address") == 1) | (F.col("f_path") == 1) | (F.col("f_covered") >= 0.8) | (F.col("f_digits") == 0)
    label = F.when(form | (named & ~plain), 1).when(plain & ~named, 0)
    return described.withColumn("label", label).where("label IS NOT NULL")


def train(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> PipelineModel | None:
    """A random forest on a bounded sample of labelled findings; None where one label is missing."""
    usable = labelled.where(~held_out(F.col("doc_id"))).withColumn("label", F.col("label").cast("int"))
    key = F.concat_ws(":", F.col("doc_id").cast("string"), "line_no", "word_no", "secret")
    sample = checkpointed(class_sample(usable, "label", key, fit_rows).select(F.col("label").cast("double").alias("label"), *FEATURES))
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="f_all")
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="f_all"), forest]).fit(sample)


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, line_no, word_no, secret, probability, kept: every candidate of every whole text."""
    # the few rows of candidates are used by the fit and by the scan
    described = checkpointed(features(candidates(docs), dictionary(docs)))
    model = train(seed_labels(described) if labelled is None else labelled)
    if model is None:
        judged = described.withColumn("probability", F.lit(None).cast("double"))
    else:
        judged = model.transform(described).withColumn("probability", F.element_at(vector_to_array("probability"), 2))
    kept = F.coalesce(F.col("probability") >= threshold, F.lit(True))
    return judged.select("doc_id", "line_no", "word_no", "secret", "probability", kept.alias("kept"))
