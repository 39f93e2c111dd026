"""Personal data in whole texts: patterns propose spans, checksums confirm them, nearby
words adjust a score. All in SQL expressions; no row leaves its partition.

Base kinds, leftmost and without overlap within a kind: ``email``, ``ip`` (parts up to
255), ``card`` (12 to 19 digits passing Luhn), ``phone`` (9 to 15 digits). A proposal that
fails its check is dropped and not tried again shorter. Kinds that the method adds:
``iban`` (country, two check digits, remainder 1 modulo 97) and ``ssn`` (three, two and
four digits, only near a word that speaks of one).

Each span carries a score: a base for its kind, raised by a checksum and by context words
within ``NEAR`` characters before it.

Positions count code points, ends are exclusive. They come from splitting the text at the
matches: piece and match lengths, summed up, are the positions.

Patterns repeat possessively, so the matcher neither recurses nor goes back over long
runs; a start inside a run that has just failed is skipped by looking behind it, except
right after a match.

Defined cases: a null or empty text has no span; the longest texts are searched whole;
repeated rows and null ids each get their own row; an empty table gives no row; other
columns are ignored, or kept by :func:`redact`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posmetrics.llm.common import table

# fixed values: kinds in their order, and their patterns
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# a text without this string cannot match; the search for it is far cheaper than the pattern
NEEDS = {"email": "@", "phone": "+", "ip": ".", "ssn": "-"}
KINDS = tuple(PATTERNS)
BASE = KINDS[:4]
NEAR = 40
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.3}
RAISED = 0.1
SSN_LEAST = 0.5
# fixed values: words near a span that speak for its kind
CONTEXT = {
    "email": "mail|contact|write|address",
    "ip": r"\bip\b|host|server|address|login",
    "card": "card|credit|visa|master|payment|pay",
    "phone": "phone|call|tel|mobile|fax|whatsapp",
    "iban": "iban|bank|account|transfer",
    "ssn": "ssn|social security|social|security number",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_IP = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def luhn(digits: F.Column) -> F.Column:
    """Whether a string of digits passes Luhn's check."""
    n = F.length(digits)

    def weighed(total: F.Column, i: F.Column) -> F.Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        double = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), weighed) % 10 == 0


def mod97(value: F.Column) -> F.Column:
    """Whether an account number leaves 1 modulo 97 after its first four signs went last
    and letters became 10 to 35."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(rest: F.Column, sign: F.Column) -> F.Column:
        code = F.ascii(sign)
        letter = code >= 65
        number = F.when(letter, code - 55).otherwise(code - 48)
        return (rest * F.when(letter, 100).otherwise(10) + number) % 97

    return F.aggregate(F.split(turned, "(?!^)(?!$)"), F.lit(0), step) == 1


def _valid(kind: str, value: F.Column) -> F.Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(_IP)
    if kind == "card":
        return F.length(digits).between(12, 19) & F.when(F.length(digits) < 20, luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return mod97(value)
    return F.lit(True)


def _spans(kind: str, text: F.Column) -> F.Column:
    """Confirmed spans of a kind: array of structs kind, begin, until, value, score."""
    pattern = PATTERNS[kind]
    # pieces between matches, each with the match after it; the last has none
    pieces = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    pairs = F.arrays_zip(pieces.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))
    empty = F.array().cast("array<struct<begin:int,until:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def place(state: F.Column, pair: F.Column) -> F.Column:
        begin = state["at"] + pair["gap"]
        until = begin + F.length(pair["value"])
        span = F.struct(begin.alias("begin"), until.alias("until"), pair["value"].alias("value"))
        return F.when(pair["value"].isNull(), state).otherwise(
            F.struct(until.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))
        )

    placed = F.aggregate(pairs, start, place, lambda s: s["out"])
    kept = F.filter(placed, lambda s: _valid(kind, s["value"]))

    def scored(span: F.Column) -> F.Column:
        width = F.least(span["begin"], F.lit(NEAR))
        before = F.lower(F.substring(text, span["begin"] - width + 1, width))
        near = F.when(before.rlike(CONTEXT[kind]), RAISED * (3 if kind == "ssn" else 1)).otherwise(0.0)
        return F.struct(
            F.lit(kind).alias("kind"),
            span["begin"].cast("long").alias("begin"),
            span["until"].cast("long").alias("until"),
            span["value"].alias("value"),
            F.round(F.lit(BASE_SCORE[kind]) + near, 2).alias("score"),
        )

    out = F.transform(kept, scored)
    if kind == "ssn":
        out = F.filter(out, lambda s: s["score"] >= SSN_LEAST)
    none = F.array().cast("array<struct<kind:string,begin:bigint,until:bigint,value:string,score:double>>")
    possible = text.contains(NEEDS[kind]) if kind in NEEDS else text.rlike("[0-9]")
    return F.when(possible, out).otherwise(none)


def find(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with an array of spans (kind, begin, until, value, score) ordered by begin,
    then kind; it replaces a column of its name."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    ordered = F.concat(*(_spans(k, text) for k in KINDS))
    ranks = F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))))

    def compare(a: F.Column, b: F.Column) -> F.Column:
        return F.signum(
            (a["begin"] * len(KINDS) + ranks[a["kind"]]) - (b["begin"] * len(KINDS) + ranks[b["kind"]])
        ).cast("int")

    return docs.withColumn(spans_col, F.array_sort(ordered, compare))


def redact(docs: DataFrame, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """``docs`` with every span of at least that score replaced by ``[KIND]`` in the text.
    Overlapping spans become one mark, named after the first. Texts without a span, null
    ones among them, stay as they are; all columns are kept."""
    own = "_spans_to_redact"
    text = F.col(text_col)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def cut(state: F.Column, span: F.Column) -> F.Column:
        fresh = span["begin"] >= state["at"]
        gap = F.substring(text, (state["at"] + 1).cast("int"), (span["begin"] - state["at"]).cast("int"))
        mark = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(state["at"], span["until"]).alias("at"),
            F.when(fresh, F.concat(state["out"], gap, mark)).otherwise(state["out"]).alias("out"),
        )

    def finish(state: F.Column) -> F.Column:
        return F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))

    wanted = F.filter(own, lambda s: s["score"] >= least)
    new = F.when(F.size(wanted) > 0, F.aggregate(wanted, start, cut, finish)).otherwise(text)
    return find(docs, text_col, own).withColumn(text_col, new).select(*docs.columns)


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def written(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["until"])), ",")

    def count(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    # the spans are made once, below the expressions that read them several times
    return find(docs).drop("text").select(
        "doc_id",
        *(count(k) for k in BASE),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )
