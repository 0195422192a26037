"""Personal data: candidates from wide patterns, judged by boosted trees.

Base spans are the matches of four strict formats with their checks; they are
always redacted. High-recall generators propose further spans that may overlap
(loosely written addresses, numbers with any separators, read as address, card
or phone). A gradient boosting model over format and context features scores
them; it is fitted on the candidates of all documents. A candidate's label does
not ask for the base formats: its separators and spelled-out signs are brought
to one form, and it is personal data if that form is valid for its kind and it
is no piece of a longer token; forms that plain numbers share also need a word
before them that says so. The threshold of each kind is calibrated on
held-out candidates: the lowest at which nearly all that score higher are
personal data. Chosen candidates that overlap no base span and no better
candidate are added.

Defined results: a null or empty text has no spans; repeated rows are judged
alike; candidates of one class only add nothing. Spans are compared by sweeps
over their sorted ends, so very long texts full of candidates cost n log n.
Input columns of any name are carried along and never read; only ``_base`` and
``_spans`` are replaced by the columns added here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import trees
from tidewatch.llm.common import let, text_of
from tidewatch.llm.spans import add_matches, apart_from, clusters
from tidewatch.operators.joins import materialise

KINDS = ("email", "ip", "card", "phone")
MIN_PRECISION, MIN_SUPPORT = 0.995, 20

# The base formats, written so that long runs cost linear time: possessive
# repeats, and no second start inside a run that has failed already.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE_MAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?|\x20at\x20)"
             r"[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]++)++")
WIDE_NUMBER = r"(?:\+|\()?[0-9](?:[\x20().:/-]{0,2}[0-9])++"
_AT, _DOT = r"\x20?[(\[]at[)\]]\x20?|\x20at\x20", r"\x20?[(\[]dot[)\]]\x20?|\x20dot\x20"
# Endings of addresses written in plain words ("me at host dot org"); those that are common English words are left out.
_ENDINGS = ("com|org|net|edu|gov|mil|int|info|biz|dev|app|io|co|eu|us|uk|de|fr|es|nl|ch|pl|se|dk|fi|jp|cn|ru|br|ca|au|nz|ie|pt|cz|gr|hu|ro|"
            "tr|ua|kr|mx|ar|cl|za|sg|hk")
# Card numbers by issuer and length; national phone numbers that their form alone tells; dates.
_CARD = r"^(?:4[0-9]{15}(?:[0-9]{3})?|(?:5[1-5]|2[2-7])[0-9]{14}|3[47][0-9]{13}|3(?:0[0-5]|[689][0-9])[0-9]{11}|6[0-9]{15,18})$"
_NATIONAL = r"^(?:1[\x20.-])?\(?[2-9][0-9]{2}\)?[\x20./-]{1,2}[2-9][0-9]{2}[\x20./-][0-9]{4}$"
_DATE = r"(?:^|[^0-9])(?:19|20)[0-9]{2}[./-]|^[0-9]{1,2}[./-][0-9]{1,2}[./-](?:[0-9]{2}){1,2}(?![0-9])"
_OWN_HINT = {2: r"(?:^|[^a-z])(?:card|visa|mastercard|amex)(?:\x20?(?:number|no|nr))?\W*$",
             3: r"(?:^|[^a-z])(?:tel|telephone|phone|fax|call|mobile|cell)(?:\x20?(?:number|no|nr))?\W*$"}

FEATURES = ["kind", "length", "digits", "letters", "dots", "spaces", "dashes", "parens", "colons", "plus", "at", "luhn",
            "groups", "max_part", "longest_run", "left_word", "right_word", "left_hint", "right_space", "line_start",
            "canon", "glued", "own_hint"]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _valid(kind: str, m: Column) -> Column:
    d = F.length(_digits(m))
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3)
                        & (F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return (d >= 16) & (d <= 19) & F.call_function("luhn_check", _digits(m))
    if kind == "phone":
        return (d >= 8) & (d <= 15)
    return F.lit(True)


def _canon(kind: int, m: Column) -> Column:
    """2: valid for its kind in canonical form, 1: valid, but plain numbers look so too, 0: not valid."""
    d = _digits(m)
    groups = F.size(F.filter(F.split(m, "[^0-9]+"), lambda p: p != ""))
    if kind == 0:
        plain = F.regexp_replace(F.regexp_replace(m, _AT, "@"), _DOT, ".")
        # A bare "at" is a preposition before "host.org", and a bare "dot" a noun before most words.
        prose = (m.rlike(r"\x20at\x20") & ~m.rlike(_DOT)) | (m.rlike(r"\x20dot\x20") & ~F.lower(plain).rlike(rf"\.(?:{_ENDINGS})$"))
        full = plain.rlike(r"^[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9][A-Za-z0-9-]*\.)+[A-Za-z]{2,}$") & ~prose
        half = F.lit(False)
    elif kind == 1:
        plain = F.translate(m, " ()", "")
        full = plain.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$") & _valid("ip", plain) & plain.rlike("[0-9]{3}")
        half = F.lit(False)
    elif kind == 2:
        half = d.rlike(_CARD) & F.call_function("luhn_check", d) & m.rlike(r"^[0-9]{3,}(?:[\x20./-]{1,2}[0-9]{3,})*$")
        full = half & ((groups > 1) | (F.length(d) >= 16))
    else:
        half = (groups > 1) & ~m.rlike(":") & ~m.rlike(_DATE) & (F.length(d) <= 15)
        full = half & (m.rlike(_NATIONAL) | m.rlike(r"^\+|^\(?00[1-9]") & (F.length(d) >= 9))
    return F.when(full, 2).when(half, 1).otherwise(0)


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_base``: array of (k, s, e), by kind and start; and the text as ``_t``."""
    out = docs.withColumn("_t", text_of(text))
    digit = F.regexp_like("_t", F.lit("[0-9]"))
    out = out.withColumn("_digit", digit)
    guards = {"email": F.contains("_t", F.lit("@")), "ip": F.col("_digit"), "card": F.col("_digit"),
              "phone": F.contains("_t", F.lit("+")) & F.col("_digit")}
    for kind in KINDS:
        out = add_matches(out, f"_f_{kind}", "_t", BASE[kind], guards[kind])

    def checked(k: int, kind: str) -> Column:
        return F.transform(F.filter(f"_f_{kind}", lambda x: _valid(kind, x["m"])),
                           lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    return out.withColumn("_base", F.concat(*(checked(k, kind) for k, kind in enumerate(KINDS)))).drop(*(f"_f_{k}" for k in KINDS))


def _features(kind: int, x: Column) -> Column:
    """Struct of span and feature values of a candidate of kind number ``kind``."""
    k, m = F.lit(kind), x["m"]

    def n(chars: str) -> Column:
        return (F.length(m) - F.length(F.translate(m, chars, ""))).cast("double")

    d = _digits(m)
    parts = F.filter(F.split(m, "[^0-9]+"), lambda p: p != "")
    values = {
        "kind": k, "length": F.length(m), "digits": F.length(d), "letters": F.length(F.regexp_replace(m, "[^A-Za-z]", "")),
        "dots": n("."), "spaces": n(" "), "dashes": n("-"), "parens": n("()["), "colons": n(":/"), "plus": n("+"), "at": n("@"),
        "luhn": F.call_function("luhn_check", d).cast("int"), "groups": F.size(parts),
        "max_part": F.least(F.coalesce(F.array_max(F.transform(parts, lambda p: F.right(p, F.lit(9)).try_cast("double"))), F.lit(0.0)), F.lit(1e6)),
        "longest_run": F.coalesce(F.array_max(F.transform(parts, lambda p: F.length(p))), F.lit(0)),
        "left_word": x["l"].rlike("[A-Za-z0-9_.=\"'-]$").cast("int"), "right_word": x["r"].rlike("^[A-Za-z0-9_=\"'-]").cast("int"),
        "left_hint": F.lower(x["l"]).rlike(r"(mail|tel|phone|fax|call|mobile|card|visa|ip|host|address|contact)\W*$").cast("int"),
        "right_space": (x["r"].rlike(r"^[\s,.;)]") | (x["r"] == "")).cast("int"), "line_start": (x["l"].rlike(r"\n$") | (x["l"] == "")).cast("int"),
        "canon": _canon(kind, m), "glued": (x["l"].rlike("[A-Za-z0-9_@+]$|[A-Za-z0-9][.-]$") | x["r"].rlike("^[A-Za-z0-9_@]|^[.-][A-Za-z0-9]")).cast("int"),
        "own_hint": F.lower(x["l"]).rlike(_OWN_HINT[kind]).cast("int") if kind in _OWN_HINT else F.lit(0),
    }
    return F.struct(k.cast("int").alias("k"), x["s"].alias("s"), x["e"].alias("e"), m.alias("m"),
                    *(F.coalesce(values[f].cast("double"), F.lit(0.0)).alias(f"f_{f}") for f in FEATURES))


def with_candidates(based: DataFrame) -> DataFrame:
    """Adds ``_cand``: wide candidates, each with its features."""
    out = add_matches(based, "_w_mail", "_t", WIDE_MAIL, F.contains("_t", F.lit("@")) | F.regexp_like("_t", F.lit(r"[(\[\x20]at[)\]\x20]")))
    out = add_matches(out, "_w_num", "_t", WIDE_NUMBER, F.col("_digit"))
    numbers = F.filter("_w_num", lambda x: F.length(_digits(x["m"])) >= 4)

    def reading(k: int, test) -> Column:
        return F.transform(F.filter(numbers, test), lambda x: _features(k, x))

    return out.withColumn("_cand", F.concat(
        F.transform("_w_mail", lambda x: _features(0, x)),
        reading(1, lambda x: F.size(F.split(x["m"], "[.:]")) == 4),
        reading(2, lambda x: (F.length(_digits(x["m"])) >= 13) & (F.length(_digits(x["m"])) <= 19)),
        reading(3, lambda x: (F.length(_digits(x["m"])) >= 7) & (F.length(_digits(x["m"])) <= 15)),
    )).drop("_w_mail", "_w_num")


def _holds_base(k: Column, m: Column) -> Column:
    def has(kind: str) -> Column:
        return F.exists(F.regexp_extract_all(m, F.lit(BASE[kind]), F.lit(0)), lambda x: _valid(kind, x))

    out = F.lit(False)
    for n, kind in enumerate(KINDS):
        out = F.when(k == n, has(kind)).otherwise(out)
    return out


def _label(c: str) -> Column:
    """1 for personal data: strictly written, or valid in canonical form and told so by form or context."""
    told = (F.col(f"{c}.f_glued") == 0) & (F.col(f"{c}.f_canon") + F.col(f"{c}.f_own_hint") >= 2)
    return (told | _holds_base(F.col(f"{c}.k"), F.col(f"{c}.m"))).cast("int")


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[trees.Model | None, dict[int, float]]:
    """(model, threshold by kind) from the candidates of all documents: two thirds fit the model, one third is held out."""
    slim = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    # Written before it is exploded: the filter that Spark infers from explode would repeat the whole expression.
    cand = materialise(with_candidates(with_base(slim)).select("_id", "_cand"), "pii-candidates").select("_id", F.explode("_cand").alias("c"))
    cand = cand.select("_id", F.col("c.s").alias("_s"), F.col("c.k").alias("_k"), _label("c").alias("_y"),
                       *(F.col(f"c.f_{f}").alias(f) for f in FEATURES))
    cand = cand.withColumn("_held", F.pmod(F.xxhash64(F.xxhash64("_id", "_s", "_k"), F.lit(5)), F.lit(3)) == 0)
    rows, cuts = trees.prepare_counted(cand, FEATURES, ["_held", "_k", "_y"], "pii")
    model = trees.fit_boosted(rows.where("not _held"), FEATURES, cuts, counted=True)
    if model is None:
        return None, {}
    # Reliability of the score on held-out candidates, in 50 bins a kind.
    seen = (rows.where("_held").withColumn("_bin", F.floor(model.binned_score() * 50)).groupBy("_k", "_bin")
            .agg(F.sum(F.col("_n") * F.col("_y")).alias("p"), F.sum("_n").alias("n")).collect())
    thresholds = {}
    for k in range(len(KINDS)):
        p = n = 0
        for r in sorted((r for r in seen if r["_k"] == k), key=lambda r: -r["_bin"]):
            p, n = p + r["p"], n + r["n"]
            if n >= MIN_SUPPORT and p >= MIN_PRECISION * n:
                thresholds[k] = r["_bin"] / 50
    return model, thresholds


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fitted=None) -> DataFrame:
    """``docs`` with ``_base`` and ``_spans``: arrays of (k: kind number, s, e), by kind and start."""
    model, thresholds = fit(docs, doc_id, text) if fitted is None else fitted
    own = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("_base", "_spans")]
    out = with_base(docs.select(F.struct("*").alias("row"), F.col(text).alias("text")))
    if model is None or not thresholds:
        return out.select(*own, "_base", F.col("_base").alias("_spans"))
    out = with_candidates(out)
    scored = F.transform("_cand", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), c["k"].alias("k"),
                                                     model.score(lambda f: c[f"f_{f}"]).alias("p")))
    out = out.withColumn("_scored", F.when(F.size("_cand") > 0, scored))

    def enough(c: Column) -> Column:
        need = F.lit(None).cast("double")
        for k, t in thresholds.items():
            need = F.when(c["k"] == k, F.lit(t)).otherwise(need)
        return c["p"] >= need

    def best(of: Column) -> Column:
        return F.filter(of, lambda c: ~F.exists(of, lambda o: (o["s"] < c["e"]) & (c["s"] < o["e"]) & ((o["p"] > c["p"]) | ((o["p"] == c["p"]) & (
            F.struct(o["k"].alias("k"), o["s"].alias("s")) < F.struct(c["k"].alias("k"), c["s"].alias("s")))))))

    out = out.withColumn("_picked", F.filter("_scored", enough))
    out = out.withColumn("_picked", F.when(F.size("_picked") > 0, F.flatten(F.transform(
        clusters(apart_from(F.col("_picked"), F.col("_base"))), best))))
    added = F.coalesce(F.transform("_picked", lambda c: F.struct(c["k"].alias("k"), c["s"].alias("s"), c["e"].alias("e"))),
                       F.array().cast("array<struct<k:int,s:bigint,e:bigint>>"))
    return out.select(*own, "_base", F.array_sort(F.concat("_base", added)).alias("_spans"))


def digest(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets."""
    out = find(docs, doc_id, text)
    names = F.array(*map(F.lit, KINDS))
    t = F.col(text)
    by_place = F.array_sort(F.transform("_spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    state = F.aggregate(by_place, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), lambda a, x: F.struct(
        F.concat(a["out"], F.substring(t, a["at"].cast("int") + 1, F.greatest(x["s"] - a["at"], F.lit(0)).cast("int")),
                 F.when(x["s"] >= a["at"], F.concat(F.lit("["), F.upper(F.get(names, x["k"])), F.lit("]"))).otherwise("")).alias("out"),
        F.greatest(a["at"], x["e"]).alias("at")))
    redacted = let(state, lambda r: F.concat(r["out"], F.substring(t, r["at"].cast("int") + 1, F.lit((1 << 31) - 1))))
    return out.withColumn(text, F.when(F.size("_spans") == 0, t).otherwise(redacted)).drop("_base", "_spans")
