"""Secret scans: token candidates, false positives removed by a random forest.

Every run of at least ``MIN_LENGTH`` characters of the token alphabet is a
candidate, and so is every value of at least ``MIN_VALUE`` characters other
than white space (up to its closing quote) that is assigned to a credential
name. The forest judges it by its length, its character transitions
(changes between lower case, upper case, digits and signs), how much of it
common words cover, the path it was found under and the words before it. It is
fitted on labelled findings; ``labelled_findings`` derives them from provider
prefixes and assignments to credential names where no reviewed ones are given.

Defined results: a null or empty text has no candidates; a null path counts as
an empty one; repeated rows give repeated findings; without findings of both
labels every candidate gets the score null and is not reported. Further
columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import trees
from tidewatch.llm.common import text_of
from tidewatch.llm.spans import add_matches
from tidewatch.operators.joins import materialise

MIN_LENGTH, MIN_VALUE = 16, 8
MAX_TRAIN_ROWS = 10_000
THRESHOLD = 0.5
TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{MIN_LENGTH},}}+"

# Common words of code and prose that real keys do not spell out; a parameter.
WORDS = ("the and for that with from this have are not you all can was one out use get set new old key token secret password pass "
         "user name test example sample value data file path http https www com org net html json text string number null true "
         "false default config local host port main class function return public private static import license version").split()
NAMES = "password|passwd|pwd|secret|token|api.?key|access.?key|credential|auth"
HINT = rf"({NAMES})[\"']?\s*(=|:|=>)\s*[\"']?$"
# A credential name, what assigns to it, and the value up to a quote or white space.
_ASSIGN = rf"(?i)(?:{NAMES})[\"']?\s{{0,8}}+(?:=>|[=:])\s{{0,8}}+"
ASSIGNED = _ASSIGN + rf"(?:\"[^\s\"]{{{MIN_VALUE},}}+|'[^\s']{{{MIN_VALUE},}}+|[^\s\"']{{{MIN_VALUE},}}+)"

FEATURES = ["length", "digits", "upper", "lower", "signs", "changes", "letter_digit", "case_changes", "distinct", "hex",
            "covered", "vowels", "path_length", "path_code", "path_test", "hint_before", "assign_before", "quote_around", "prefix"]


def _value(x: Column) -> Column:
    """The match of an assignment cut down to its value; name and sign go to the text before it."""
    value = F.regexp_replace(x["m"], "^" + _ASSIGN + "[\"']?", "")
    size = F.length(value)
    return F.struct(value.alias("m"), (x["e"] - size).alias("s"), x["e"].alias("e"),
                    F.right(F.concat(x["l"], F.left(x["m"], F.length(x["m"]) - size)), F.lit(32)).alias("l"), x["r"].alias("r"))


def _is_token(x: Column) -> Column:
    """Is the value a whole run of token characters, and so a candidate already?"""
    return (x["m"].rlike(rf"^[A-Za-z0-9+/_=-]{{{MIN_LENGTH},}}$") & ~x["l"].rlike("[A-Za-z0-9+/_=-]$")
            & ~x["r"].rlike("^[A-Za-z0-9+/_=-]"))


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source", words=WORDS) -> DataFrame:
    """(doc_id, path, start, end, token, before) and a column per feature."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), text_of(text).alias("_t"))
    found = add_matches(base, "_x", "_t", TOKEN, F.lit(True), context=32)
    found = add_matches(found, "_y", "_t", ASSIGNED, F.regexp_like("_t", F.lit("[=:]")), context=32)
    found = found.select("doc_id", "path", F.concat("_x", F.filter(F.transform("_y", _value), lambda y: ~_is_token(y))).alias("_x"))
    # Written before it is exploded (see pii.fit).
    rows = materialise(found, "token-candidates").select("doc_id", "path", F.explode("_x").alias("x")).select(
        "doc_id", "path", F.col("x.s").alias("start"), F.col("x.e").alias("end"), F.col("x.m").alias("token"),
        F.col("x.l").alias("before"), F.col("x.r").alias("after"))
    t, size = F.col("token"), F.length("token")

    def share(pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern)) / size

    values = {
        "length": size, "digits": share("[0-9]"), "upper": share("[A-Z]"), "lower": share("[a-z]"), "signs": share("[+/_=-]"),
        "changes": share("(?<=[a-z])(?![a-z])|(?<=[A-Z])(?![A-Z])|(?<=[0-9])(?![0-9])"),
        "letter_digit": share("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"), "case_changes": share("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "distinct": F.size(F.array_distinct(F.split(t, ""))) / size, "hex": t.rlike("^[0-9a-f]+$|^[0-9A-F]+$").cast("int"),
        "covered": 1 - F.length(F.regexp_replace(F.lower(t), "(" + "|".join(sorted(words, key=lambda w: (-len(w), w))) + ")", "")) / size,
        "vowels": share("[aeiouAEIOU]"), "path_length": F.length("path"),
        "path_code": F.col("path").rlike(r"\.(py|js|ts|java|go|rb|sh|env|ya?ml|json|toml|ini|cfg)$").cast("int"),
        "path_test": F.lower("path").rlike("test|example|sample|mock|fixture|doc").cast("int"),
        "hint_before": F.lower("before").rlike(r"(password|passwd|pwd|secret|token|key|credential|auth)\W*\w*\W*$").cast("int"),
        "assign_before": F.col("before").rlike(r"[=:]\s*[\"']?$").cast("int"),
        "quote_around": (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("int"),
        "prefix": t.rlike("^[A-Z]{3,5}[A-Z0-9]+$").cast("int"),
    }
    return rows.select("doc_id", "path", "start", "end", "token", "before", *(values[f].cast("double").alias(f) for f in FEATURES))


def labelled_findings(cands: DataFrame) -> DataFrame:
    """``cands`` with ``label``: 1 for provider formats and credential assignments, else 0."""
    token = F.col("token")
    provider = token.rlike(r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^sk_(live|test)_[A-Za-z0-9]{16,}$|^xox[bap]-[0-9A-Za-z-]{16,}$")
    assigned = F.lower("before").rlike(HINT) | token.rlike(r"(?i)^(password|passwd|pwd|secret|token|api_?key)=[A-Za-z0-9+/_-]{8,}$")
    return cands.withColumn("label", (provider | assigned).cast("int"))


def fit(findings: DataFrame, label: str = "label") -> trees.Model | None:
    """Forest on at most ``MAX_TRAIN_ROWS`` labelled findings, in hash order; half of them positive if there are enough."""
    rows = findings.select(F.xxhash64("doc_id", "start", "token").alias("_row"), F.col(label).cast("int").alias("_y"), *FEATURES)
    half = [rows.where(F.col("_y") == y).orderBy("_row").limit(MAX_TRAIN_ROWS // 2) for y in (0, 1)]
    table, cuts = trees.prepare(half[0].union(half[1]), FEATURES, ["_row", "_y"], "secrets")
    return trees.fit_forest(table, FEATURES, cuts)


def find_secrets(docs: DataFrame, findings: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
                 path: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """One row per candidate: doc_id, start, end, token_sha256, score, reported."""
    cands = materialise(candidates(docs, doc_id, text, path), "token-features")
    model = fit(labelled_findings(cands) if findings is None else findings)
    score = model.score(F.col) if model is not None else F.lit(None).cast("double")
    return cands.select("doc_id", "start", "end", F.sha2("token", 256).alias("token_sha256"), score.alias("score")).withColumn(
        "reported", F.coalesce(F.col("score") >= threshold, F.lit(False)))
