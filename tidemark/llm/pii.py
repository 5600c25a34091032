"""Find personal data: four base patterns, and looser spans accepted by a classifier that is trained without labels.

Built-in functions only. Labelers (strict form, gazetteer, context, check rule, isolation) vote on candidate spans: matches
of the base patterns, those that their rules refuse, looser spans, and for contrast plain numbers and pairs of words
around "at". Expectation-maximisation over the counts of vote patterns of all documents estimates how reliable each
labeler is; with these reliabilities and the shapes of what looks personal, a naive Bayes classifier has the last
word on looser spans.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, ready, written
from tidemark.llm.spans import SPAN, by_kind, count_kind, match_spans, overlaps, span_list

KINDS = ("email", "ip", "card", "phone", "email_like", "phone_like", "number_like")

# Lookbehinds and possessive quantifiers change no match: they spare tries that must fail.
LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
OCTETS = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
#: A shorter run fails whatever it is, so that the prefilter may ask for the least number of digits.
CARD_PRESENT = r"[0-9](?:[\x20-]?[0-9]){15}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Looser spans: written-out addresses, numbers without a plus, long numbers in groups.
EMAIL_LIKE = (
    rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++(?:\x20?[\[(](?:at|AT)[\])]\x20?|\x20(?:at|AT)\x20)[A-Za-z0-9-]++"
    r"(?:(?:\x20?[\[(](?:dot|DOT)[\])]\x20?|\x20(?:dot|DOT)\x20|\.)[A-Za-z0-9-]++)++"
)
PHONE_LIKE = r"(?<![0-9+.-])(?:\([0-9]{2,5}\)\x20?|0[0-9]{1,4}[\x20/-])[0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,3}(?![0-9])"
NUMBER_LIKE = r"(?<![0-9A-Za-z])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?)(?![0-9A-Za-z])"

#: One of these is in every written-out address, the first two in every pair of words around "at".
WRITTEN_AT = (" at ", " AT ", "[at]", "(at)", "[AT]", "(AT)", "[at)", "(at]", "[AT)", "(AT]")
# For contrast: numbers in any form, and pairs of words around "at" (a written-out address without its end).
PLAIN_NUMBER = r"(?<![0-9A-Za-z.+-])[0-9]++(?:[.:/,-][0-9]++)*+(?![0-9A-Za-z])"
AT_WORDS = r"(?<![A-Za-z])[A-Za-z]++\x20(?:at|AT)\x20[A-Za-z]++"

# Fixed lists of the labelers.
TOP_DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|eu|at|ch|it"
IBAN_COUNTRIES = "DE|FR|ES|IT|NL|BE|AT|CH|GB|PT|IE|LU"
CUES = (
    "mail|contact|address|adresse|correo|phone|tel|call|fax|mobile|cell|anruf|appel|llam|"
    "card|visa|carte|karte|tarjeta|iban|ssn|social|account|konto|compte|cuenta|server|host"
)
REACH = 32
THRESHOLD = 0.9
VOTES = 5
ROUNDS = 50
#: A labeler is better than chance: its yes is at least so many times as likely, in odds, for personal data.
LEAST_ODDS = 4.0
#: With fewer candidates than this in either class the data tell nothing of reliabilities, and FIRST_RATES hold.
LEAST_CLASS = 10
FIRST_RATES = (0.7, 0.3)
FIRST_SHARE = 0.5
#: A shape may add so much to the log odds or take it away: few kinds are in the training data, so shapes never outvote labelers.
SHAPE_LIMIT = 1.0


#: Forms that nothing but their kind is written in.
STRICT = (
    rf"^[{LOCAL}]++@|[\[(](?:at|AT)[\])]|^[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}$|^[0-9]{{4}}(?:[\x20-]?[0-9]{{4}}){{3}}[0-9]{{0,3}}$"
    r"|^\+[0-9(]|^\([0-9]+\)|^0[0-9]+/|^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$|^[A-Z]{2}[0-9]{2}(?:\x20?[0-9]{4}){3,}"
)
GAZETTEER = rf"(?i)[.\x20)\]](?:{TOP_DOMAINS})$|^(?:{IBAN_COUNTRIES})[0-9]|^(?:4|5[1-5]|3[47]|6011)[0-9]{{3}}[\x20-]?[0-9]{{4}}|^\+(?:1|33|34|44|49)\b"
#: The end of a written-out or plain address: small or capital letters throughout, as a sentence does not begin.
TOP_LEVEL = r"(?:\.|dot[\])]?\x20|DOT[\])]?\x20|dot[\])]|DOT[\])])(?:[a-z]{2,6}|[A-Z]{2,6})$"

# ------------------------------------------------------------------ spans


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a string of digits is right."""

    def weigh(d: Column, i: Column, n: Column) -> Column:
        twice = (n - i) % 2 == 0
        return F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    def total(ds: Column) -> Column:
        return F.aggregate(F.transform(ds, lambda d, i: weigh(d, i, F.size(ds))), F.lit(0), lambda a, x: a + x)

    return let(F.transform(F.split(number, ""), lambda c: c.cast("int")), total) % 10 == 0


def card_ok(span: Column) -> Column:
    return let(digits(span["match"]), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))


def phone_digits(match: Column) -> Column:
    return F.length(digits(match)).between(8, 15)


def phone_ok(span: Column) -> Column:
    return phone_digits(span["match"])


def ip_ok(span: Column) -> Column:
    return span["match"].rlike(OCTETS)


RULES = {"email": lambda span: F.lit(True), "ip": ip_ok, "card": card_ok, "phone": phone_ok}


def spans_if(present: Column, text: Column, pattern: str, kind: str, rank: int) -> Column:
    """Matches of a pattern, looked for only where a text holds what every match holds."""
    return F.when(present, match_spans(text, pattern, kind, rank)).otherwise(F.array().cast(SPAN))


def holds(text: Column, *parts: str) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in parts])


def base_matches(text: Column) -> Column:
    """All matches of the base patterns, whether or not their rules accept them."""
    return F.concat(
        spans_if(holds(text, "@"), text, EMAIL, "email", 0),
        match_spans(text, IP, "ip", 1),
        spans_if(text.rlike(CARD_PRESENT), text, CARD, "card", 2),
        spans_if(holds(text, "+"), text, PHONE, "phone", 3),
    )


def rule(span: Column) -> Column:
    """Whether the rule of a base match's kind accepts it."""
    out = F
    for kind, accepts in RULES.items():
        out = out.when(span["kind"] == kind, accepts(span))
    return out


def loose_spans(text: Column) -> Column:
    return F.concat(
        spans_if(holds(text, *WRITTEN_AT), text, EMAIL_LIKE, "email_like", 4),
        match_spans(text, PHONE_LIKE, "phone_like", 5),
        match_spans(text, NUMBER_LIKE, "number_like", 6),
    )


def contrast_spans(text: Column) -> Column:
    """What is hardly ever personal, of digits and of letters: numbers of any form, and words around "at"."""
    return F.concat(match_spans(text, PLAIN_NUMBER, "plain", 7), spans_if(holds(text, *WRITTEN_AT[:2]), text, AT_WORDS, "plain", 8))


# ------------------------------------------------------------------ labelers and cells


def iban_ok(code: Column) -> Column:
    """Remainder 1 by 97 of the code with its first four characters behind, letters as numbers from 10."""
    turned = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))
    values = F.transform(F.split(turned, ""), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    return F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def number_ok(match: Column) -> Column:
    """Three, two and four digits as they are issued, or an account number whose check digits are right."""
    bare = F.replace(match, F.lit(" "), F.lit(""))
    return F.when(match.rlike("^[0-9]"), ~match.rlike("^(?:000|666|9)|-00-|-0000$")).otherwise(iban_ok(bare))


def votes(span: Column, text: Column) -> Column:
    """The pattern of the five labelers' votes as an int, bit by bit."""
    match, kind = span["match"], span["kind"]
    before = F.lower(F.substr(text, F.greatest(span["start"] - REACH + 1, F.lit(1)), F.least(span["start"], F.lit(REACH))))
    strict = match.rlike(STRICT)
    gazetteer = match.rlike(GAZETTEER)
    context = before.rlike(rf"\b(?:{CUES})")
    check = (
        F.when(kind.isin("email", "email_like"), match.rlike(TOP_LEVEL))
        .when(kind.isin("phone", "phone_like"), phone_digits(match))
        .when(kind == "number_like", number_ok(match))
        .when(kind.isin("ip", "card"), rule(span))
        .otherwise(False)
    )
    alone = before.rlike(r"(?:^|[\s:(<\"'\[])$")
    bits = [strict, gazetteer, context, check, alone]
    return sum((F.when(b, F.lit(1 << i)).otherwise(F.lit(0)) for i, b in enumerate(bits)), F.lit(0))


#: Shapes: digits, other characters, letters by fours, the next character; each with its number of values.
SHAPES = (21, 9, 9, 4)


def shapes(span: Column, text: Column) -> list[Column]:
    match = span["match"]
    after = F.substr(text, span["end"] + 1, F.lit(1))
    return [
        F.least(F.length(digits(match)), F.lit(20)),
        F.least(F.length(F.regexp_replace(match, "[A-Za-z0-9]", "")), F.lit(8)),
        F.least(F.floor(F.length(F.regexp_replace(match, "[^A-Za-z]", "")) / 4).cast("int"), F.lit(8)),
        F.when(after == "", F.lit(0)).when(after.rlike(r"\s"), F.lit(1)).when(after.rlike("[A-Za-z0-9]"), F.lit(2)).otherwise(F.lit(3)),
    ]


def cell(span: Column, text: Column) -> Column:
    """Shapes and votes of a span in one int: the votes are its last digits to the base 32."""
    out = F.lit(0)
    for value, size in zip(shapes(span, text), SHAPES, strict=True):
        out = out * size + value
    return (out * (1 << VOTES) + votes(span, text)).cast("int")


def unpack(packed: int) -> tuple[list[int], int]:
    """(shapes, votes) of a cell."""
    packed, pattern = divmod(packed, 1 << VOTES)
    out = []
    for size in reversed(SHAPES):
        packed, value = divmod(packed, size)
        out.append(value)
    return out[::-1], pattern


@dataclass(frozen=True)
class Classifier:
    """Log odds: a constant, for each labeler what its no and its yes add, and by shape and value what that adds (unseen values nothing)."""

    constant: float
    labelers: tuple[tuple[float, float], ...]
    weights: tuple[dict[int, float], ...]
    reliability: tuple[tuple[float, float], ...] = field(default=())


# ------------------------------------------------------------------ training


def better_than_chance(p: float, q: float, pooled: float) -> tuple[float, float]:
    """(P(yes | personal), P(yes | other)) moved apart around the pooled rate where their odds are not LEAST_ODDS apart."""
    if p * (1 - q) >= LEAST_ODDS * q * (1 - p):
        return p, q
    odds, apart = pooled / (1 - pooled), math.sqrt(LEAST_ODDS)
    return odds * apart / (1 + odds * apart), odds / apart / (1 + odds / apart)


def estimate(counts: dict[int, float]) -> tuple[float, list[tuple[float, float]], dict[int, float]]:
    """EM over vote patterns: (share of personal data, (P(yes | personal), P(yes | other)) of each labeler, posterior by pattern).

    Reliabilities stay better than chance in every round, so the classes cannot change places or become one.
    """
    total = sum(counts.values())
    pooled = [(sum(n for v, n in counts.items() if v >> i & 1) + 1) / (total + 2) for i in range(VOTES)]
    share, rates = FIRST_SHARE, [FIRST_RATES] * VOTES
    posterior = _posteriors(counts, share, rates)
    for _ in range(ROUNDS):
        personal = sum(n * posterior[v] for v, n in counts.items())
        if min(personal, total - personal) < LEAST_CLASS:
            first = [FIRST_RATES] * VOTES
            return FIRST_SHARE, first, _posteriors(counts, FIRST_SHARE, first)
        share = (personal + 1) / (total + 2)
        rates = []
        for i in range(VOTES):
            yes = [(n * posterior[v], n * (1 - posterior[v])) for v, n in counts.items() if v >> i & 1]
            p, q = (sum(x) + 1 for x in zip(*yes, strict=True)) if yes else (1, 1)
            rates.append(better_than_chance(p / (personal + 2), q / (total - personal + 2), pooled[i]))
        posterior = _posteriors(counts, share, rates)
    return share, rates, posterior


def _posteriors(counts: dict[int, float], share: float, rates: list[tuple[float, float]]) -> dict[int, float]:
    out = {}
    for pattern in counts:
        yes, no = share, 1 - share
        for i, (p, q) in enumerate(rates):
            on = pattern >> i & 1
            yes *= p if on else 1 - p
            no *= q if on else 1 - q
        out[pattern] = yes / (yes + no)
    return out


def fit(cells: dict[int, int]) -> Classifier:
    """The classifier from counts of cells: labelers weigh by their reliabilities, shapes by posteriors of the votes beside them."""
    by_votes: dict[int, float] = {}
    for packed, n in cells.items():
        pattern = unpack(packed)[1]
        by_votes[pattern] = by_votes.get(pattern, 0) + n
    share, rates, posterior = estimate(by_votes)
    sums: list[dict[int, list[float]]] = [{} for _ in SHAPES]
    total = [1.0, 1.0]
    for packed, n in sorted(cells.items()):
        values, pattern = unpack(packed)
        both = (n * posterior[pattern], n * (1 - posterior[pattern]))
        for k in (0, 1):
            total[k] += both[k]
            for at, value in enumerate(values):
                sums[at].setdefault(value, [0.5, 0.5])[k] += both[k]

    def weight(a: float, b: float) -> float:
        return max(-SHAPE_LIMIT, min(SHAPE_LIMIT, math.log(a / total[0]) - math.log(b / total[1])))

    labelers = tuple((math.log((1 - p) / (1 - q)), math.log(p / q)) for p, q in rates)
    weights = tuple({v: weight(a, b) for v, (a, b) in sorted(x.items())} for x in sums)
    return Classifier(math.log(share / (1 - share)), labelers, weights, tuple(rates))


# ------------------------------------------------------------------ spots: spans with their cells


def spot(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base``, the base spans, ``_loose``, looser spans overlapping none of them with their cells, and ``_cells`` of all candidates."""
    text = F.col("text")

    def with_cells(matches: Column) -> Column:
        base = F.filter(matches, rule)

        def spots(kept: Column) -> Column:
            loose = F.filter(loose_spans(text), lambda x: ~overlaps(x, kept))

            def rest(near: Column) -> Column:
                taken = F.concat(matches, near)
                plain = F.filter(contrast_spans(text), lambda x: ~overlaps(x, taken))
                # Base spans of a prefix of digits stay as they are; refused ones count once.
                every = F.concat(matches, plain)
                return F.struct(
                    kept.alias("base"),
                    F.transform(near, lambda x: F.struct(x.alias("span"), cell(x, text).alias("cell"))).alias("loose"),
                    F.transform(every, lambda x: cell(x, text)).alias("cells"),
                )

            return let(loose, rest)

        return let(base, spots)

    spotted = docs.withColumn("_spots", let(base_matches(text), with_cells))
    return spotted.select(
        *docs.columns, F.col("_spots.base").alias("_base"), F.col("_spots.loose").alias("_loose"),
        F.concat("_spots.cells", F.transform("_spots.loose", lambda x: x["cell"])).alias("_cells"),
    )


def learn(spotted: DataFrame) -> Classifier:
    """Fit on the candidates of all documents. At most as many counts as there are cells, 217,728, reach the driver."""
    cells = spotted.select(F.explode("_cells").alias("cell")).groupBy("cell").count()
    return fit(dict(cells.collect()))


def train(docs: DataFrame) -> Classifier:
    """The classifier of ``docs`` alone, to be used on others."""
    return learn(spot(docs.select("text")))


def probability(packed: Column, model: Classifier) -> Column:
    """That a span with this cell is personal data."""
    odds = F.lit(model.constant)
    for i, (no, yes) in enumerate(model.labelers):
        odds = odds + F.when(packed.bitwiseAND(F.lit(1 << i)) != 0, F.lit(yes)).otherwise(F.lit(no))
    rest = F.floor(packed / (1 << VOTES))
    for size, weights in zip(reversed(SHAPES), reversed(model.weights), strict=True):
        table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else None
        if table is not None:
            odds = odds + F.coalesce(F.try_element_at(table, (rest % size).cast("int")), F.lit(0.0))
        rest = F.floor(rest / size)
    return 1 / (1 + F.exp(-odds))


# ------------------------------------------------------------------ the operator


def find_personal_data(docs: DataFrame, model: Classifier | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (kind, rank, start, end, match, value) by kind, then start.

    Places are code points of the original text, ends exclusive. ``spans`` has the base spans and those looser
    spans, overlapping none of them, that the classifier accepts. Without a ``model`` the candidates of all rows train one;
    what was found is written once, so that texts are searched once. A null or empty text has no span; repeated rows
    are judged and counted each; with too few candidates the labelers weigh alike. An empty table gives an empty
    one. Other columns pass through; ``base`` and ``spans`` of the input are replaced.
    """
    ready(docs.sparkSession)
    given = docs.drop("base", "spans")
    spotted = spot(given)
    if model is None:
        spotted = written(spotted, "personal-spots")
        model = learn(spotted)
    accepted = F.filter("_loose", lambda x: probability(x["cell"], model) >= threshold)
    return spotted.select(
        *[F.col(f"`{c}`") for c in given.columns],
        by_kind(F.col("_base")).alias("base"),
        by_kind(F.concat("_base", F.transform(accepted, lambda x: x["span"]))).alias("spans"),
    )


def digest(found: DataFrame) -> DataFrame:
    """doc_id, a count of each base kind, the hash of the base spans and all spans."""
    return found.select(
        "doc_id",
        *[count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )
