"""Secret scans: patterns, and a battery of randomness tests over long tokens.

A token of an encoding (hex, base26 to base64) is a secret if it cannot be
text, by evidence of the battery: its letters are too uniform, its runs of one
kind of character too short, and vowels and consonants follow each other as
chance has it. The null hypothesis is a token put together from words, so few
symbols are little evidence. Benjamini and Hochberg's procedure bounds the share
of false secrets in each encoding and length class over the whole corpus. What
rejects randomness as well (a counter, few symbols in turn) is no secret either. All
of it is column expressions; the corpus-wide step is a histogram of bounded size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstone.llm.common import let, settle, whole


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
PATTERNS = {
    "assign": rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
    "random": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}",
}
KINDS = list(PATTERNS)
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: Encoding, what the token must look like, and the alphabet its symbols are numbered by.
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$|^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", DIGITS + LOWER[:6]),
    ("base26", r"^[a-z]+$|^[A-Z]+$", LOWER),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", LOWER + DIGITS[2:8]),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$|^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", DIGITS + LOWER),
    ("base52", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z]+$", LOWER.upper() + LOWER),
    ("base64", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+=*$", LOWER.upper() + LOWER + DIGITS + "+/"),
)
#: p-values are kept as steps of a fiftieth of a power of ten, down to 1e-20.
STEPS, LAST_STEP = 50, 1000


@dataclass(frozen=True)
class Control:
    """``rate``: the share of a class's secrets that may be text after all. A random token is dismissed with
    probability ``level``. Values shorter than ``assigned`` are no secrets."""

    rate: float = 0.05
    level: float = 0.001
    assigned: int = 8


@dataclass(frozen=True)
class Prose:
    """What tokens put together from words are like, on the cautious side for the languages of Europe.

    ``pair`` and ``triple`` are the chances that two or three letters of a text are the same, ``turn`` that a vowel
    follows a consonant or the other way round, ``run`` that a character begins a word or number, ``number`` the same
    in tokens of one case. ``hex`` is the share of letters up to f.
    """

    pair: float = 0.0667
    triple: float = 0.0055
    turn: float = 0.58
    run: float = 0.28
    number: float = 0.2
    hex: float = 0.3


def matches(text: Column, kind: str) -> Column:
    """The matches of a kind in order, each with the number of characters since the last one."""
    pattern = F.lit(PATTERNS[kind])
    row = "array<struct<kind:int,at:int,gap:int,hit:string>>"
    return let(
        F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda hits: F.when(F.size(hits) == 0, F.array().cast(row)).otherwise(
            let(
                F.split(text, PATTERNS[kind], -1),
                lambda gaps: F.transform(
                    hits,
                    lambda h, i: F.struct(
                        F.lit(KINDS.index(kind)).alias("kind"), i.alias("at"), F.length(F.get(gaps, i)).alias("gap"), h.alias("hit")
                    ),
                ),
            ).cast(row)
        ),
    )


def located(rows: DataFrame) -> DataFrame:
    """(row, kind, start, end, hit) of the matches, in code points."""
    hits = rows.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    run = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("hit")).over(run)
    return hits.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit")).drop("at", "gap")


def tail(z: Column) -> Column:
    """The probability of a normal value above ``z``, by a rational approximation of the error function."""
    x = F.abs(z) / 2**0.5
    t = 1 / (1 + 0.3275911 * x)
    # The coefficients of formula 7.1.26 in Abramowitz and Stegun.
    poly = ((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t
    upper = poly * F.exp(-x * x) / 2
    return F.when(z >= 0, upper).otherwise(1 - upper)


def step(p: Column) -> Column:
    p = F.greatest(F.lit(1e-300), F.least(F.lit(1.0), p))
    return F.least(F.lit(LAST_STEP), F.floor(-F.log10(p) * STEPS)).cast("int")


def against_prose(hit: Column, prose: Prose) -> Column:
    """The p-value of a token under the hypothesis that it is made of words.

    One-sided normal statistics, added up: equal pairs of letters (the uniformity
    of the alphabet), runs of a word or number, neighbours that differ in being
    a vowel. Runs say nothing where all are letters of one case. A hex token is
    judged by its letters, which words would seldom take from the first six.
    """
    low = F.lower(hit)
    letters = F.regexp_count(low, F.lit("[a-z]")).cast("double")
    counts = F.transform(F.split(F.lit(LOWER), ""), lambda c: F.regexp_count(low, c).cast("double"))
    equal = F.aggregate(counts, F.lit(0.0), lambda s, c: s + c * (c - 1) / 2)
    pairs = letters * (letters - 1) / 2
    spread = pairs * (prose.pair - prose.pair**2) + pairs * 2 * (letters - 2) * (prose.triple - prose.pair**2)
    uniform = F.when(letters > 2, (pairs * prose.pair - equal) / F.sqrt(spread))
    neighbours = F.regexp_count(low, F.lit("[a-z](?=[a-z])")).cast("double")
    turned = F.regexp_count(low, F.lit("[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])"))
    serial = F.when(neighbours > 0, (neighbours * prose.turn - turned) / F.sqrt(neighbours * prose.turn * (1 - prose.turn)))
    signs = F.regexp_count(hit, F.lit("[A-Za-z0-9]")).cast("double")
    mixed = F.rlike(hit, F.lit("[a-z]")) & F.rlike(hit, F.lit("[A-Z]"))
    began = F.when(mixed, F.regexp_count(hit, F.lit("[A-Z]?[a-z]+|[A-Z]|[0-9]+"))).otherwise(F.regexp_count(low, F.lit("[a-z]+|[0-9]+")))
    runs = F.when(
        (mixed | F.rlike(hit, F.lit("[0-9]"))) & (signs > 0),
        let(F.when(mixed, prose.run).otherwise(prose.number), lambda q: (began - signs * q) / F.sqrt(signs * q * (1 - q))),
    )
    told = F.filter(F.array(uniform, serial, runs), lambda z: z.isNotNull())
    z = F.aggregate(told, F.lit(0.0), lambda s, x: s + x) / F.sqrt(F.greatest(F.lit(1), F.size(told)).cast("double"))
    return F.when(F.col("encoding") == "hex", F.pow(F.lit(prose.hex), letters)).otherwise(tail(z))


def against_chance(value: Column, alphabet: Column) -> Column:
    """The p-value of a token under the hypothesis that all its symbols are drawn alike: chi-squared, runs, serial correlation."""
    n, m = F.length(value).cast("double"), F.length(alphabet).cast("double")
    squares = F.aggregate(
        F.transform(
            F.sequence(F.lit(1), F.length(alphabet)),
            lambda k: F.length(value) - F.length(F.replace(value, F.substring(alphabet, k, F.lit(1)), F.lit(""))),
        ),
        F.lit(0.0),
        lambda s, c: s + c.cast("double") * c,
    )
    chi = m / n * squares - n
    numbers = F.transform(
        F.sequence(F.lit(1), F.length(value)),
        lambda i: F.instr(alphabet, F.substring(value, i, F.lit(1))).cast("double") - 1 - (m - 1) / 2,
    )

    def combined(places: Column) -> Column:
        # Symbol numbers around their mean: turns are changes of sign, and neighbours' products have mean 0.
        turns = F.aggregate(
            F.transform(places, lambda x, i: F.when((x > 0) != (F.get(places, i + 1) > 0), 1.0).otherwise(0.0)),
            F.lit(0.0), lambda s, x: s + x,
        )
        products = F.aggregate(
            F.transform(places, lambda x, i: x * F.coalesce(F.get(places, i + 1), F.lit(0.0))), F.lit(0.0), lambda s, x: s + x
        )
        uniform = (chi - (m - 1)) / F.sqrt(2 * (m - 1) * (n - 1) / n)
        turned = (turns - (n - 1) / 2) / (F.sqrt(n - 1) / 2)
        serial = products / ((m * m - 1) / 12) / F.sqrt(n - 1)
        return 3 * F.least(tail(uniform), 2 * tail(F.abs(turned)), 2 * tail(F.abs(serial)))

    return let(numbers, combined)


def tested(tokens: DataFrame, prose: Prose = Prose()) -> DataFrame:
    """Tokens of an encoding with ``encoding``, ``size_class``, ``step`` (the p-value under prose) and ``chance`` (under chance)."""
    encoding, alphabet = F, F
    for name, looks, symbols in ENCODINGS:
        fits = F.rlike("hit", F.lit(looks))
        encoding, alphabet = encoding.when(fits, F.lit(name)), alphabet.when(fits, F.lit(symbols))
    plain = F.translate(F.col("hit"), "-_=", "+/")
    value = F.when(F.col("encoding").isin("base52", "base64"), plain).otherwise(F.lower(plain))
    known = tokens.withColumn("encoding", encoding).withColumn("alphabet", alphabet).filter("encoding is not null")
    return known.withColumn("value", value).select(
        "row", "kind", "start", "end", "encoding",
        F.floor(F.log2(F.length("value"))).cast("int").alias("size_class"),
        step(against_prose(F.col("hit"), prose)).alias("step"),
        against_chance(F.col("value"), F.col("alphabet")).alias("chance"),
    )


def cutoffs(scored: DataFrame, control: Control) -> DataFrame:
    """(c_encoding, c_class, cutoff): the step from which a token is no prose, by Benjamini and Hochberg.

    A class of m tokens, k of them at a step or beyond, rejects from the first
    step whose p-value is at most rate * k / m. At most one row for each
    encoding and power of two.
    """
    of = Window.partitionBy("encoding", "size_class")
    beyond = of.orderBy(F.col("step").desc())
    counts = scored.groupBy("encoding", "size_class", "step").agg(F.count("*").alias("n"))
    edge = F.pow(F.lit(10.0), -F.col("step") / STEPS)
    kept = counts.withColumn("k", F.sum("n").over(beyond)).withColumn("m", F.sum("n").over(of))
    kept = kept.filter(edge <= control.rate * F.col("k") / F.col("m"))
    return kept.groupBy(F.col("encoding").alias("c_encoding"), F.col("size_class").alias("c_class")).agg(F.min("step").alias("cutoff"))


def scan(docs: DataFrame, control: Control = Control()) -> DataFrame:
    """(doc_id, spans) for every row of ``docs``; spans are (start, kind, end), by start, then kind.

    Kinds are numbered as in KINDS; the last, tokens that pass the battery, is
    left out where it meets a span of the others. A NULL text is empty. Repeated
    rows are scanned one by one, and count one by one in the control.
    """
    text = whole("text")
    found = F.concat(*[matches(text, k) for k in KINDS])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", found.alias("hits"))
    rows = settle(rows, "secret-rows")
    spans = located(rows.filter(F.size("hits") > 0))
    value = F.regexp_extract("hit", PATTERNS["assign"], 2)
    base = spans.filter((F.col("kind") < 3) & ((F.col("kind") != 0) | (F.length(value) >= control.assigned)))
    scored = settle(tested(spans.filter(F.col("kind") == 3)), "secret-tested")
    # A few rows: encodings times powers of two.
    limits = F.broadcast(cutoffs(scored, control))
    passed = scored.join(limits, (F.col("encoding") == F.col("c_encoding")) & (F.col("size_class") == F.col("c_class")))
    passed = passed.filter((F.col("step") >= F.col("cutoff")) & (F.col("chance") >= control.level))
    both = base.select("row", "kind", "start", "end").union(passed.select("row", "kind", "start", "end"))
    by_start = Window.partitionBy("row").orderBy("start", "kind")
    is_base = F.col("kind") < 3
    before = F.max(F.when(is_base, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(is_base, F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    meets = (F.coalesce(before, F.lit(0)) > F.col("start")) | (F.coalesce(after, F.col("end")) < F.col("end"))
    alone = both.withColumn("meets", meets).filter(is_base | ~F.col("meets"))
    lists = alone.groupBy(F.col("row").alias("l_row")).agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    none = F.array().cast(lists.schema["spans"].dataType)
    return rows.join(lists, F.col("row") == F.col("l_row"), "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")


def op1(docs: DataFrame) -> DataFrame:
    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")

    return scan(docs).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(written(F.filter("spans", lambda s: s.kind < 3)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        count(3).alias("n_random"),
    )
