"""Personal data: patterns propose spans, checksums confirm them, context adjusts them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shopstar.llm.tables import beside
from shopstar.llm.text import whole

# Fixed by the query contract: kinds in their order, and what each pattern takes.
# Quantifiers are possessive where nothing after them could take a shorter run,
# and a match starts at the start of its run or where the last match ended; both
# leave the matches as they are and keep the time linear in the text.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A cheap look whether a text can hold a match at all.
HINT = {
    "email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}", "local_phone": r"[0-9][\x20.-][0-9]", "secret": r"[a-z0-9]{16}|AKIA[A-Z0-9]{16}",
}
OCTETS = r"^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$"
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Extra:
    """A kind that the contract does not fix: counted if its score reaches the threshold."""

    kind: str
    pattern: str
    prior: float
    context: str


EXTRAS = (
    Extra("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
          0.6, r"(?i)\b(iban|account|konto|cuenta|compte|bank|banque|banco)\b"),
    Extra("local_phone", r"(?<![0-9A-Za-z.+-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z-])",
          0.3, r"(?i)\b(phone|tel|telephone|telefon|t[eé]l[eé]fono|call|mobile|fax)\b"),
    Extra("secret", r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|[a-f0-9]{40}|[a-z0-9]{16,20}(?=$|[\s\"',;]))(?![A-Za-z0-9])",
          0.3, r"(?i)(password|passwd|token|secret|api[_-]?key|akia|access)"),
)


@dataclass(frozen=True)
class PiiRules:
    threshold: float = 0.5
    context_bonus: float = 0.3
    checksum_bonus: float = 0.3
    context_chars: int = 40


# Sums are built over slices of so many numbers, on so many levels, and texts are
# cut into chunks of so many code points; neither changes a result.
SLICE, LEVELS = 32, 3
CHUNK = 256


def pieces(text: Column, n: int, pattern: str, hint: str) -> Column:
    """The text as gaps, each with the match behind it ('' after the last): array of (kind, gap, hit)."""
    hits = F.concat(F.regexp_extract_all(text, F.lit(pattern), 0), F.array(F.lit("")))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    pairs = F.transform(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda p: F.struct(
        F.lit(n).alias("kind"), p["gap"].alias("gap"), p["hit"].alias("hit")))
    none = F.array(F.struct(F.lit(n).alias("kind"), F.length(text).alias("gap"), F.lit("").alias("hit")))
    return F.when(text.rlike(hint), pairs).otherwise(none)


def with_sums(df: DataFrame, column: str, out: str) -> DataFrame:
    """Adds, for every number of an array, the sum of those before it.

    A short array is summed anew for every number. In a longer one slices are
    summed, then slices of slices; the sum before a number is that before its slice
    and of the few before it within the slice. So the work grows with the array,
    where a running list would be copied for every number. Every array is mentioned
    twice where it is used: the optimizer then keeps it as a column and does not
    build it anew per element.
    """
    zero = F.lit(0).cast("bigint")

    def total(numbers: str, start: Column, n: Column) -> Column:
        return F.aggregate(F.slice(numbers, start, n), zero, lambda a, x: a + x)

    def of_slices(below: str) -> Column:
        n = F.greatest(F.ceil(F.size(below) / SLICE).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(1), n), lambda i: total(below, (i - 1) * SLICE + 1, F.lit(SLICE)))

    def within(below: str) -> Column:
        own = lambda i: F.floor(i / SLICE).cast("int")
        last = F.least(F.size(below), F.size("_before") * SLICE) - 1
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.get("_before", own(i)) + total(
            below, own(i) * SLICE + 1, i % SLICE))

    def direct(numbers: str) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(numbers)), lambda i: total(numbers, F.lit(1), i - 1))

    long = F.size(column) > SLICE
    names = [column]
    for level in range(LEVELS):
        df = df.withColumn(f"_sums{level}", F.when(long, of_slices(names[-1])))
        names.append(f"_sums{level}")
    top = names.pop()
    df = df.withColumn("_before", F.when(long, direct(top)))
    for below in reversed(names):
        df = df.withColumn("_next", F.when(long, within(below))).drop("_before").withColumnRenamed("_next", "_before")
    return df.withColumn(out, F.when(long, F.col("_before")).when(F.size(column) > 0, direct(column)).otherwise(
        F.expr("cast(array() as array<bigint>)"))).drop("_before", *names[1:], top)


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if every second digit from the right, doubled, brings the sum to a multiple of 10."""
    n = F.length(digits)

    def value(i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + value(i))
    return F.coalesce(total % 10 == 0, F.lit(False))


def mod97(match: Column) -> Column:
    """True if the number spelled by the rearranged account has the remainder 1."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(a, c):
        v = F.instr(F.lit(ALPHABET), c) - 1
        return F.when(v > 9, (a * 100 + v) % 97).otherwise((a * 10 + v) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def confirmed(span: Column) -> Column:
    """What the contract asks of a base match."""
    kind, match = span["kind"], span["match"]
    n = F.length(digits_of(match))
    return (
        F.when(kind == "ip", match.rlike(OCTETS))
        .when(kind == "card", F.when(n.between(12, 19), luhn(digits_of(match))).otherwise(False))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(True))


def find_pii(docs: DataFrame, rules: PiiRules = PiiRules(), text: str = "text") -> DataFrame:
    """`docs` with pii: array of (start, rank, kind, end, match, score, base), by start and kind.

    Base kinds that pass their check always stay; their score says how sure they
    are. Further kinds are kept if pattern, checksum and context words within
    context_chars reach the threshold and no base span overlaps them. Null and
    empty texts have no span; every row is judged by itself, repeated ones alike.
    """
    t = whole(text)
    kinds = [*BASE, *(e.kind for e in EXTRAS)]
    patterns = [*BASE.values(), *(e.pattern for e in EXTRAS)]
    names = F.array(*map(F.lit, kinds))
    order = F.create_map(*[F.lit(x) for i, k in enumerate(kinds) for x in (k, i)])

    def near(s: Column) -> Column:
        """The match with context_chars on both sides, from the chunks that hold them."""
        first = F.greatest(s["start"] - rules.context_chars, F.lit(0)).cast("int")
        chunk = F.floor(first / CHUNK).cast("int")
        length = (s["end"] - s["start"] + 2 * rules.context_chars).cast("int")
        part = F.array_join(F.slice("_chunks", chunk + 1, F.floor((first + length) / CHUNK).cast("int") - chunk + 1), "")
        return F.substring(part, first - chunk * CHUNK + 1, length)

    def scored(s, is_base: bool):
        if is_base:
            context = near(s).rlike(r"(?i)\b(mail|e-mail|contact|card|visa|phone|call|tel|server|host|ip)\b")
            prior = F.when(s["kind"] == "card", F.lit(0.5 + rules.checksum_bonus)).otherwise(F.lit(0.7))
        else:
            context = reduce(
                lambda a, e: F.when(s["kind"] == e.kind, near(s).rlike(e.context)).otherwise(a),
                EXTRAS, F.lit(False))
            prior = reduce(
                lambda a, e: F.when(s["kind"] == e.kind, F.lit(e.prior)).otherwise(a),
                EXTRAS, F.lit(0.0))
            prior = F.when((s["kind"] == "iban") & ~mod97(s["match"]), F.lit(-1.0)).otherwise(
                prior + F.when(s["kind"] == "iban", F.lit(rules.checksum_bonus)).otherwise(F.lit(0.0)))
        score = prior + F.when(context, F.lit(rules.context_bonus)).otherwise(F.lit(0.0))
        return F.struct(
            s["start"].alias("start"), order[s["kind"]].alias("rank"), s["kind"].alias("kind"),
            s["end"].alias("end"), s["match"].alias("match"),
            F.least(F.round(score, 2), F.lit(1.0)).alias("score"), F.lit(is_base).alias("base"))

    def free(s: Column) -> Column:
        """No base span overlaps: of those of a kind that start before the end, the last one decides."""
        def last_before(spans: str) -> Column:
            # Halves the range of candidates until one is left.
            step = lambda a, _: F.when(a["low"] < a["high"], F.when(
                F.get(spans, F.floor((a["low"] + a["high"]) / 2).cast("int"))["start"] < s["end"],
                F.struct((F.floor((a["low"] + a["high"]) / 2) + 1).cast("int").alias("low"), a["high"].alias("high")),
            ).otherwise(F.struct(
                a["low"].alias("low"), F.floor((a["low"] + a["high"]) / 2).cast("int").alias("high")))).otherwise(a)
            steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + F.lit(1.0))).cast("int"))
            found = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(spans).alias("high")), step)
            return F.get(spans, found["low"] - 1)

        return reduce(lambda a, kind: a & F.coalesce(
            last_before(f"_base_{kind}")["end"] <= s["start"], F.lit(True)), BASE, F.lit(True))

    def checked(kind: str) -> Column:
        return F.filter("_spans", lambda s: (s["kind"] == kind) & confirmed(s))

    def work(own: DataFrame) -> DataFrame:
        every = own.withColumn("_pieces", F.concat(*[
            pieces(t, n, pattern, HINT[kind]) for n, (kind, pattern) in enumerate(zip(kinds, patterns, strict=True))]))
        # Texts without a match have one gap per kind and need no offsets.
        some = F.size("_pieces") > len(kinds)
        lengths = F.transform("_pieces", lambda p: (p["gap"] + F.length(p["hit"])).cast("bigint"))
        sized = every.withColumns({
            "_lengths": F.when(some, lengths).otherwise(F.expr("cast(array() as array<bigint>)")),
            "_chars": F.length(t).cast("bigint")})
        placed = with_sums(sized, "_lengths", "_at").withColumns({
            "_spans": F.filter(F.transform(
                F.arrays_zip(F.when(some, F.col("_pieces")).otherwise(F.slice("_pieces", 1, 0)).alias("piece"),
                             F.col("_at").alias("at")),
                lambda p: F.struct(
                    (p["at"] + p["piece"]["gap"] - p["piece"]["kind"] * F.col("_chars")).alias("start"),
                    (p["at"] + p["piece"]["gap"] + F.length(p["piece"]["hit"])
                     - p["piece"]["kind"] * F.col("_chars")).alias("end"),
                    F.get(names, p["piece"]["kind"]).alias("kind"), p["piece"]["hit"].alias("match"))),
                lambda s: s["match"] != ""),
        }).drop("_pieces", "_lengths", "_at")
        chunks = F.when(F.size("_spans") > 0, F.regexp_extract_all(t, F.lit(f"(?s).{{1,{CHUNK}}}"), 0))
        split = placed.withColumns({"_chunks": chunks, **{f"_base_{kind}": checked(kind) for kind in BASE}})
        extra = split.withColumn("_more", F.filter(
            F.filter("_spans", lambda s: ~s["kind"].isin(*BASE)), free))
        return extra.withColumns({
            "_base": F.transform(F.concat(*[f"_base_{kind}" for kind in BASE]), lambda s: scored(s, True)),
            "_more": F.filter(F.transform("_more", lambda s: scored(s, False)), lambda s: s["score"] >= rules.threshold),
        }).withColumn("pii", F.array_sort(F.concat("_base", "_more"))).drop(
            "_spans", "_chunks", "_chars", "_base", "_more", *[f"_base_{kind}" for kind in BASE])

    return beside(docs, [text], ["pii"], work)


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint")


def span_list(found: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    return F.array_join(F.transform(
        found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
