"""Operator 7: personal data by weak supervision, in DataFrame functions only.

Base spans are the valid matches of four patterns (email, ip, card, phone).
Further candidates come from wider patterns.  Five labelers vote on every
candidate, base ones included: the strict pattern, the shape of the match, a
gazetteer, the cue words to its left and the characters at its edges.
Expectation-maximisation over the counts of the vote patterns (at most 3**5
rows, whatever the corpus) estimates how far each labeler can be trusted; the
resulting posteriors train a naive Bayes classifier on the features of the
spans.  Wider candidates that it accepts and that touch no base span are added.

Positions come from the pieces between matches, so a text is never cut.  The
patterns are written so that Java's matcher neither recurses per repetition nor
rescans a run: possessive loops, and starts only where a run begins.

Arrays of matches are walked in one pass each, so a text with very many matches
takes time in proportion to them.

Defined cases: a null text counts as empty; repeated rows are each reported;
without candidates nothing is added; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evseq.llm.common import pick, written

ITERATIONS = 12
CHUNK = 256  # matches gathered at once
SPAN = "struct<start: int, end: int, match: string, left: string, right: string>"
TAGGED = "struct<rank: int, start: int, end: int, kind: string, base: boolean, match: string, left: string, right: string>"
#: fixed values: the base patterns, equal in their matches to
#: email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#: ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#: card [0-9]([\x20-]?[0-9])+ with 16 to 19 digits
#: phone \+[0-9][\x20().0-9-]+[0-9]
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![0-9])(?![ -][0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: characters without which a pattern cannot match
GUARD = {"email": "@", "ip": ".", "phone": "+"}
#: wider patterns, by the kind that they may be
WIDER = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++ ?[(\[{] ?at ?[)\]}] ?[a-z0-9-]++(?: ?(?:\.|[(\[{] ?dot ?[)\]}]) ?[a-z0-9-]{2,}+)++",
    "phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])[0-9a-fA-F]{24,}+(?![A-Za-z0-9])",
}
WIDER_GUARD = {"email": r"(?i)[(\[{] ?at ?[)\]}]"}
KINDS = ["email", "ip", "card", "phone", "iban", "secret"]
CUES = (
    "mail|contact|write|phone|tel|call|fax|mobile|cell|card|visa|iban|account|konto|cuenta|compte|token|secret|key|password|"
    "passwd|pwd|auth|apikey|ssn|server|host|addr"
)
AGAINST = "isbn|issn|version|page|vol|fig|sha1|sha256|md5|commit|checksum|revision"
# fixed values of the gazetteer
DOMAINS = (
    "com org net edu gov mil int info biz name pro io ai app dev me tv cc co uk de fr es it nl be at ch li lu dk se no fi is ie pt gr pl cz sk "
    "hu ro bg hr si rs ua ru by lt lv ee tr il ae sa za eg ma ng ke in pk bd lk cn hk tw jp kr sg my th vn id ph au nz us ca mx br ar cl pe uy eu"
)
NO_DOMAINS = "example invalid test localhost local png jpg jpeg gif svg css js html htm txt pdf zip md py java json xml"
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 CH21 CY28 CZ24 DE22 DK18 EE20 ES24 FI18 FR27 GB22 GE22 GI23 GR27 HR21 HU28 IE22 "
    "IL23 IS26 IT27 KW30 KZ20 LB28 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MT31 NL18 NO15 PL28 PT25 QA29 RO24 RS22 SA24 SE24 SI19 SK24 "
    "SM27 TN24 TR26 UA29"
)
CALLING_CODES = (
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 "
    "21[1-8] 2[2-6][0-9] 29[0-9] 35[0-9] 37[0-9] 38[0-9] 42[0-3] 50[0-9] 59[0-9] 67[0-9] 68[0-9] 85[0-6] 88[0-8] 96[0-8] 97[0-9] 99[2-8]"
)
CARD_PREFIXES = "4 5[1-5] 22[2-9] 2[3-6] 27[01] 2720 34 37 6011 64[4-9] 65 35 30[0-5] 36 38 39 62 50 5[6-8]"
TEST_CARDS = "4111111111111111 4242424242424242 4012888888881881 5555555555554444 5105105105105100 5500000000000004 6011111111111117"
NO_NETWORKS = r"^0*(?:0|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."  # this host, loopback, multicast, reserved
LABELERS = ["pattern", "shape", "gazetteer", "context", "edges"]


def scan(items: Column, state: Column, step, out_type: str) -> Column:
    """One pass over an array with a running state: ``step(state, item)`` gives
    (next state, output); returns the outputs.  They are gathered in chunks, as
    growing one array would copy it at every item."""

    def one(acc, item):
        state, out = step(acc["state"], item)
        return F.struct(state.alias("state"), F.concat(acc["out"], F.array(out)).alias("out"))

    def fresh(state):
        return F.struct(state.alias("state"), F.array().cast(f"array<{out_type}>").alias("out"))

    def chunk(acc, items):
        return F.struct(
            F.aggregate(items, fresh(acc["last"]["state"]), one).alias("last"),
            F.concat(acc["done"], F.array(acc["last"]["out"])).alias("done"),
        )

    def whole(items):
        starts = F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), F.lit(CHUNK))
        chunks = F.transform(starts, lambda a: F.slice(items, a, F.lit(CHUNK)))
        nothing = F.struct(fresh(state).alias("last"), F.array().cast(f"array<array<{out_type}>>").alias("done"))
        return F.aggregate(chunks, nothing, chunk, lambda acc: F.flatten(F.concat(acc["done"], F.array(acc["last"]["out"]))))

    # the array is bound once; a slice of an expression would work it out each time
    return F.transform(F.array(items), whole)[0]


def located(text: Column, pattern: str, guard: Column) -> Column:
    """[(start, end, match, left, right)] of a pattern's matches, in code points;
    ``left``: up to 24 characters before a match, ``right``: the one after it.
    All is put together from the pieces between matches: to look a place up in
    the text would read it from its beginning."""
    none = F.array().cast(f"array<{SPAN}>")
    found = F.when(guard, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    between = F.split(text, pattern, -1)
    n = F.size(found)

    def step(state, pair):
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        left = F.right(F.concat(state["tail"], pair["gap"]), F.lit(24))
        out = F.struct(
            start.alias("start"), end.alias("end"), pair["match"].alias("match"), left.alias("left"), pair["right"].alias("right")
        )
        tail = F.right(F.concat(state["tail"], pair["gap"], pair["match"]), F.lit(24))
        return F.struct(end.alias("at"), tail.alias("tail")), out

    following = F.concat(F.slice(found, 2, n), F.array(F.lit("")))
    rights = F.zip_with(F.slice(between, 2, n), following, lambda g, m: F.when(g != "", F.left(g, F.lit(1))).otherwise(F.left(m, F.lit(1))))
    pairs = F.zip_with(found, F.slice(between, 1, n), lambda m, g: F.struct(m.alias("match"), g.alias("gap")))
    pairs = F.zip_with(
        pairs, rights, lambda p, r: F.struct(p["match"].alias("match"), p["gap"].alias("gap"), r.alias("right"))
    )
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"))
    return F.when(n > 0, scan(pairs, begin, step, SPAN)).otherwise(none)


def apart(wide: Column, firm: Column) -> Column:
    """Spans of ``wide`` that touch none of ``firm``: both in the order of their
    starts, one pass for base spans that start at or before a wide one, and one
    backwards for those that start later."""

    def place(s, k):
        return F.struct(s["start"].alias("start"), F.lit(k).alias("wide"), s["end"].alias("end"), s.alias("s"))

    def forward(reach, x):
        is_wide = x["wide"] == 1
        return F.when(is_wide, reach).otherwise(F.greatest(reach, x["end"])), F.struct(x.alias("x"), (is_wide & (reach > x["start"])).alias("hit"))

    def backward(following, e):
        x = e["x"]
        is_wide = x["wide"] == 1
        after = F.when(is_wide, following).otherwise(x["start"])
        return after, F.struct(x["s"].alias("s"), (is_wide & ~e["hit"] & (following >= x["end"])).alias("keep"))

    spot = f"struct<start: int, wide: int, end: int, s: {TAGGED}>"
    every = F.array_sort(F.concat(F.transform(firm, lambda s: place(s, 0)), F.transform(wide, lambda s: place(s, 1))))
    there = scan(every, F.lit(0), forward, f"struct<x: {spot}, hit: boolean>")
    back = scan(F.reverse(there), F.lit(2**31 - 1), backward, f"struct<s: {TAGGED}, keep: boolean>")
    kept = F.transform(F.filter(F.reverse(back), lambda e: e["keep"]), lambda e: e["s"])
    return F.when((F.size(firm) > 0) & (F.size(wide) > 0), kept).otherwise(wide)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        # at most 255: no leading zeros counted, three digits at most
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _valid_only(kind: str) -> Column:
    return F.filter(f"b_{kind}", lambda s: valid(kind, s["match"]))


def _tagged(spans: Column, kind: str, base: bool) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(KINDS.index(kind)).alias("rank"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.lit(base).alias("base"),
            s["match"].alias("match"),
            s["left"].alias("left"),
            s["right"].alias("right"),
        ),
    )


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, spans (base ones and wider candidates apart from them)."""
    text = F.col("text")
    base = pick(docs, id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    for kind, pattern in BASE.items():
        guard = F.contains(text, F.lit(GUARD[kind])) if kind in GUARD else F.lit(True)
        base = base.withColumn(f"b_{kind}", located(text, pattern, guard))
    for kind, pattern in WIDER.items():
        guard = text.rlike(WIDER_GUARD[kind]) if kind in WIDER_GUARD else F.lit(True)
        base = base.withColumn(f"w_{kind}", located(text, pattern, guard))
    firm = F.concat(*[_tagged(_valid_only(k), k, True) for k in BASE])
    wide = F.concat(*[_tagged(F.col(f"w_{k}"), k, False) for k in WIDER])
    both = base.select("id", firm.alias("firm"), wide.alias("wide"))
    return both.select("id", F.concat("firm", apart(F.col("wide"), F.col("firm"))).alias("spans"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _among(values: str) -> str:
    return "(?:" + "|".join(values.split()) + ")"


def gazetteer(kind: Column, match: Column) -> Column:
    """Vote by tables of what exists: domains, networks, card issuers, calling
    codes, lengths of account numbers by country."""
    digits = _digits(match)
    domain = F.lower(F.regexp_extract(match, r"([A-Za-z0-9-]+)[^A-Za-z0-9-]*$", 1))
    account = F.regexp_replace(match, " ", "")
    known = F.concat(F.substring(account, 1, 2), F.length(account).cast("string"))
    international = match.startswith("+")
    return (
        F.when(kind == "email", _vote(domain.rlike(f"^{_among(DOMAINS)}$"), domain.rlike(rf"^(?:{_among(NO_DOMAINS)}|[0-9]+)$")))
        .when(kind == "ip", _vote(~match.rlike(NO_NETWORKS), match.rlike(NO_NETWORKS)))
        .when(
            kind == "card",
            _vote(digits.rlike(f"^{_among(CARD_PREFIXES)}") & ~digits.isin(*TEST_CARDS.split()), ~digits.rlike(f"^{_among(CARD_PREFIXES)}")),
        )
        .when(
            (kind == "phone") & international,
            _vote(digits.rlike(f"^{_among(CALLING_CODES)}"), ~digits.rlike(f"^{_among(CALLING_CODES)}")),
        )
        # national numbers: areas and exchanges start from 2; 555-01xx is fiction
        .when(kind == "phone", _vote(digits.rlike("^[2-9][0-9]{2}[2-9]") & ~digits.rlike("^...55501"), ~digits.rlike("^[2-9][0-9]{2}[2-9]")))
        .when(kind == "iban", _vote(known.isin(*IBAN_LENGTHS.split()), ~known.isin(*IBAN_LENGTHS.split())))
        .otherwise(0)
    )


def votes(s: Column) -> dict[str, Column]:
    """One vote (1 personal, -1 not, 0 no opinion) of each labeler."""
    match, left, digits = s["match"], F.lower(s["left"]), _digits(s["match"])
    repeated = (digits != "") & (F.replace(digits, F.left(digits, F.lit(1)), F.lit("")) == "")
    mixed = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    edge = F.right(s["left"], F.lit(1))
    return {
        "pattern": _vote(s["base"], (s["kind"] == "secret") & ~mixed),
        "shape": _vote(
            (s["kind"].isin("secret", "iban", "email") & mixed) | (F.length(digits).between(7, 15) & ~repeated),
            repeated & (F.length(digits) > 3),
        ),
        "gazetteer": gazetteer(s["kind"], match),
        "context": _vote(left.rlike(rf"(?<![a-z])(?:{CUES})"), left.rlike(rf"(?<![a-z])(?:{AGAINST})")),
        "edges": _vote(
            edge.rlike(r"^[\s\"'(<:=,]?$") & s["right"].rlike(r"^[\s\"')>.,;:!?]?$"),
            edge.rlike(r"[A-Za-z0-9/_.]") | s["right"].rlike(r"[A-Za-z0-9/_]"),
        ),
    }


def fit_labelers(patterns: DataFrame, iterations: int = ITERATIONS) -> tuple[float, dict[tuple[str, int, int], float]]:
    """Prior of a personal span and P(vote | class) by (labeler, vote, class).

    Each round is one aggregate over the vote-pattern counts; only the
    parameters, a fixed number of values, come to the driver.
    """
    prior = 0.5
    p = {(name, v, z): {1: 0.6, 0: 0.3, -1: 0.1}[v if z else -v] for name in LABELERS for v in (-1, 0, 1) for z in (0, 1)}
    for _ in range(iterations):
        weight = posterior(prior, p, {name: F.col(name) for name in LABELERS})
        n = F.col("n").cast("double")
        sums = [F.sum(n * weight).alias("one"), F.sum(n).alias("all")]
        for name in LABELERS:
            for v in (-1, 0, 1):
                here = (F.col(name) == v).cast("double") * n
                sums += [F.sum(here * weight).alias(f"{name}_{v}_1"), F.sum(here * (1 - weight)).alias(f"{name}_{v}_0")]
        row = patterns.agg(*sums).first()
        if not row["all"]:
            break
        one, zero = row["one"], row["all"] - row["one"]
        prior = (one + 1) / (row["all"] + 2)
        p = {(name, v, z): (row[f"{name}_{v}_{z}"] + 1) / ((one if z else zero) + 3) for name, v, z in p}
    return prior, p


def posterior(prior: float, p: dict[tuple[str, int, int], float], vote: dict[str, Column]) -> Column:
    """P(personal | votes)."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for name in LABELERS:
        ratio = {v: math.log(p[name, v, 1] / p[name, v, 0]) for v in (-1, 0, 1)}
        odds = odds + F.when(vote[name] == 1, ratio[1]).when(vote[name] == -1, ratio[-1]).otherwise(ratio[0])
    return 1 / (1 + F.exp(-odds))


def span_features(s: Column) -> dict[str, Column]:
    """Discrete features of a span, each of few values."""
    match = s["match"]
    n = F.length(match)
    share = F.floor(4 * F.length(_digits(match)) / F.greatest(n, F.lit(1)))
    edge = F.right(s["left"], F.lit(1))
    return {
        "kind": s["kind"],
        "size": F.least(F.floor(n / 8), F.lit(8)).cast("string"),
        "digits": share.cast("string"),
        "before": F.when(edge.rlike(r"[\s]|^$"), "space").when(edge.rlike("[A-Za-z0-9]"), "word").otherwise("mark"),
        "after": F.when(s["right"].rlike(r"[\s]|^$"), "space").when(s["right"].rlike("[A-Za-z0-9]"), "word").otherwise("mark"),
        "cue": F.lower(s["left"]).rlike(rf"(?<![a-z])(?:{CUES})").cast("string"),
        "doubt": F.lower(s["left"]).rlike(rf"(?<![a-z])(?:{AGAINST})").cast("string"),
    }


def fit_spans(weighted: DataFrame) -> tuple[float, dict[tuple[str, str], float]]:
    """Naive Bayes log odds from rows (features..., weight, n): the prior and
    one value per (feature, value); the table has a fixed, small size."""
    totals = weighted.agg(F.sum(F.col("n") * F.col("weight")).alias("one"), F.sum("n").alias("all")).first()
    if not totals["all"]:
        return 0.0, {}
    one, zero = totals["one"], totals["all"] - totals["one"]
    names = [c for c in weighted.columns if c not in ("weight", "n")]
    parts = [
        weighted.groupBy(F.lit(name).alias("feature"), F.col(name).alias("value")).agg(
            F.sum(F.col("n") * F.col("weight")).alias("one"), F.sum(F.col("n") * (1 - F.col("weight"))).alias("zero")
        )
        for name in names
    ]
    rows = reduce(DataFrame.unionByName, parts).collect()
    odds = {(r["feature"], r["value"]): math.log((r["one"] + 1) / (one + 2) / ((r["zero"] + 1) / (zero + 2))) for r in rows}
    return math.log((one + 1) / (zero + 1)), odds


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, base and spans, arrays of (rank, start, end, kind)
    sorted by kind as listed in ``KINDS`` and then by start."""
    found = written(candidates(docs, id_col, text_col), "pii-spans")
    each = found.select(F.explode("spans").alias("s"))
    s = F.col("s")
    columns = {**{f"v_{k}": c for k, c in votes(s).items()}, **{f"f_{k}": c for k, c in span_features(s).items()}}
    counted = written(
        each.select(*[c.alias(k) for k, c in columns.items()]).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")), "pii-votes"
    )
    patterns = written(
        counted.groupBy(*[F.col(f"v_{k}").alias(k) for k in LABELERS]).agg(F.sum("n").alias("n")).coalesce(1), "pii-patterns"
    )
    prior, p = fit_labelers(patterns)
    weight = posterior(prior, p, {k: F.col(f"v_{k}") for k in LABELERS})
    features = [c.removeprefix("f_") for c in columns if c.startswith("f_")]
    base_odds, odds = fit_spans(
        counted.select(*[F.col(f"f_{k}").alias(k) for k in features], weight.alias("weight"), "n")
    )

    def accepted(s: Column) -> Column:
        total = F.lit(base_odds)
        for name, value in span_features(s).items():
            for (feature, known), ratio in sorted(odds.items()):
                if feature == name:
                    total = total + F.when(value == known, ratio).otherwise(0.0)
        return s["base"] | (total > 0)

    short = lambda s: F.struct(*[s[k].alias(k) for k in ("rank", "start", "end", "kind")])
    firm = F.filter("spans", lambda s: s["base"])
    every = F.filter("spans", accepted) if odds else F.col("spans")
    return found.select(
        F.col("id").alias("doc_id"),
        F.array_sort(F.transform(firm, short)).alias("base"),
        F.array_sort(F.transform(every, short)).alias("spans"),
    )


def count_of(kind: str, spans: str = "base") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
