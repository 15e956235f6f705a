"""Personal data: expressions propose spans, checksums confirm them, words nearby move the score.

Everything is a Column expression: Spark's regular expressions find the matches, the pieces between them give the
positions, and higher-order functions compute Luhn, mod-97 and the scores.

Kinds. ``email``, ``ip``, ``card`` and ``phone`` are the base kinds: a match that passes its check is kept whatever
its score. ``iban`` (mod-97), ``tel`` (a local number without ``+``) and ``secret`` (a long hexadecimal key) are the
kinds the method adds: a proposal is kept when its score reaches ``KEEP_SCORE``. Only a passed checksum or a context
word lifts a proposal that high, so prose and plain numbers are left alone.

Defined results. Null and empty texts have no spans. Texts of any length are scanned whole: quantified groups are
possessive, which Java runs as loops, and a run that cannot start a match is entered once. Repeated rows give
repeated rows. An empty table gives an empty table. Columns of the input are carried; results that clash with them
replace them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm.common import table

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "tel", "secret")
KINDS = BASE_KINDS + ADDED_KINDS

# Characters of an IBAN by country; other codes may have any length.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV",
    29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}


def iban_expression() -> str:
    """One alternative per length, so that words after an IBAN are left out; the last takes what has another length."""
    every = []
    for length, countries in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        last = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        every.append(rf"(?:{countries})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{groups}}}{last}(?![A-Za-z0-9])")
    every.append(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(every)})"


LOCAL = r"[A-Za-z0-9._%+-]"
EXPRESSIONS = {
    # A run of local characters is tried at its first character, or where the last match ended.
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A whole run of digits with single separators, where it holds 16 to 19 of them.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": iban_expression(),
    "tel": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}(?![0-9.-])",
    "secret": r"(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])",
}
# A number of at most 255; leading zeros do not count.
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
OCTETS = rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"
# Words that speak for an added kind within CONTEXT code points on either side.
CONTEXT_WORDS = {
    "iban": r"(?i)\b(?:iban|account|konto|compte|cuenta)\b",
    "tel": r"(?i)\b(?:tel|phone|call|fax|mobile|telefon|téléphone|teléfono)\b",
    "secret": r"(?i)\b(?:token|key|secret|password|passwort)\b",
}
CONTEXT = 40
# Scores: what a proposal has of itself, what a passed checksum and a context word add.
PROPOSED = {"iban": 0.2, "tel": 0.3, "secret": 0.3}
CHECKED, NEARBY = 0.5, 0.4
KEEP_SCORE = 0.6
LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def luhn_ok(digits: Column) -> Column:
    """Luhn's check of a string of digits, from the right."""
    each = F.split(F.reverse(digits), "")

    def weigh(d: Column, i: Column) -> Column:
        value = d.try_cast("int")
        twice = value * 2
        return F.when(i % 2 == 0, value).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(F.transform(each, weigh), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def iban_ok(text: Column) -> Column:
    """ISO 7064 mod-97: the first four characters go to the end, letters count from 10."""
    plain = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        value = F.instr(F.lit(LETTERS), char) - 1
        return F.when(char == "", rest).otherwise((rest * F.when(value > 9, 100).otherwise(10) + value) % 97)

    return F.length(plain).between(15, 34) & (F.aggregate(F.split(turned, ""), F.lit(0), step) == 1)


def proposals(text: Column, kind: str) -> Column:
    """Array of (kind, start, end, hit) of the matches of one kind, leftmost and non-overlapping, in code points.

    ``split`` and ``regexp_extract_all`` find the same matches; a match starts after the pieces and matches before it.
    """
    hits = F.regexp_extract_all(text, F.lit(EXPRESSIONS[kind]), F.lit(0))
    pieces = F.split(text, EXPRESSIONS[kind], -1)
    empty = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,hit:string>>)")
    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def add(seen: Column, pair: Column) -> Column:
        begin = seen["at"] + F.length(pair["piece"])
        end = begin + F.length(pair["hit"])
        span = F.struct(
            F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), pair["hit"].alias("hit")
        )
        return F.struct(end.alias("at"), F.concat(seen["found"], F.array(span)).alias("found"))

    pairs = F.zip_with(hits, pieces, lambda h, p: F.struct(p.alias("piece"), h.alias("hit")))
    # The last piece follows the last match.
    return F.aggregate(F.filter(pairs, lambda x: x["hit"].isNotNull()), start, add, lambda seen: seen["found"])


def confirmed(text: Column, spans: Column, kind: str) -> Column:
    """The proposals that stay: base kinds by their check, added kinds by score."""
    digits = lambda s: F.regexp_replace(s["hit"], "[^0-9]", "")
    if kind == "email":
        return spans
    if kind == "ip":
        return F.filter(spans, lambda s: s["hit"].rlike(OCTETS))
    if kind == "card":
        return F.filter(spans, lambda s: F.when(F.length(digits(s)).between(16, 19), luhn_ok(digits(s))).otherwise(False))
    if kind == "phone":
        return F.filter(spans, lambda s: F.length(digits(s)).between(8, 15))

    def score(s: Column) -> Column:
        begin = F.greatest(s["start"] - CONTEXT, F.lit(0))
        around = F.substring(text, begin + 1, s["end"] + CONTEXT - begin)
        near = F.when(around.rlike(CONTEXT_WORDS[kind]), NEARBY).otherwise(0.0)
        checked = F.when(iban_ok(s["hit"]), CHECKED).otherwise(-CHECKED) if kind == "iban" else F.lit(0.0)
        return F.lit(PROPOSED[kind]) + near + checked

    return F.filter(spans, lambda s: score(s) >= KEEP_SCORE)


# A column that the stage adds for a while; no document table has such a name.
SPANS = "spans of the row"
# What a text must contain before the expression of a kind is run at all.
NEEDED = {"email": "@", "phone": "+"}


def spans_of(text: Column) -> Column:
    """The confirmed spans (kind, start, end, hit) of a text, kinds in the order of KINDS, then by start."""
    body = F.coalesce(text, F.lit(""))
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,hit:string>>)")
    by_kind = []
    for kind in KINDS:
        spans = confirmed(body, proposals(body, kind), kind)
        ready = F.contains(body, F.lit(NEEDED[kind])) if kind in NEEDED else body.rlike(r"[0-9]")
        by_kind.append(F.when(ready, spans).otherwise(none))
    return F.concat(*by_kind)


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``pii``, the spans of each text; a column of that name is replaced."""
    return docs.withColumn("pii", spans_of(F.col(f"`{text}`")))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span by its kind in brackets; overlapping spans become one, named after the first.

    Rows without spans, null texts included, come back unchanged. A column ``n_chars`` follows the new text.
    """
    body, spans = F.col(f"`{text}`"), F.col(SPANS)
    found = docs.withColumn(SPANS, spans_of(body))
    # By start, the longer first; equal spans in the order of their kinds' names.
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["kind"], s["end"])))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def put(seen: Column, s: Column) -> Column:
        fresh = s["start"] >= seen["at"]
        gap = F.substring(body, seen["at"] + 1, s["start"] - seen["at"])
        return F.struct(
            F.greatest(seen["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(seen["done"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]")))
            .otherwise(seen["done"])
            .alias("done"),
        )

    tail = lambda seen: F.concat(seen["done"], F.substring(body, seen["at"] + 1, F.length(body)))
    out = found.withColumn(text, F.when(F.size(spans) > 0, F.aggregate(ordered, start, put, tail)).otherwise(body))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(body.isNull(), F.col("n_chars")).otherwise(F.length(body)).cast(kind))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("pii")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE_KINDS]
    return find_pii(docs).select("doc_id", *counts, F.sha2(as_text(base), 256).alias("base_sha256"), as_text(spans).alias("spans"))
