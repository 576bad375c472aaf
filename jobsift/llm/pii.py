"""Personal data by candidate gradient boosting, in DataFrame operations only.

Generators with high recall propose spans that may overlap. Checked spans of the
base kinds are always kept. All others are scored by boosted trees over format, context and check
features, and a calibrated threshold selects them (as like_<generator>).

The trees learn from planted cases: values of each further generator made by rule,
right ones and ones that only look alike, behind words that speak for them or not, so
that no label is made by the rule that selects. The corpus adds what its own candidates look like that fail
their check, as further negatives. The threshold is the lowest at which, on held-out
planted cases, the wanted precision holds and, on held-out documents, no more than a small
share of these natural candidates is selected. Trees are grown from grouped gradient
sums: candidates are first counted by feature vector, so training reads a small table, and the
trees become one SQL expression.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift.functions._let import let
from jobsift.llm.common import numbered, stored

# FIXED VALUES: the base kinds' patterns, written so that the regex engine needs neither backtracking over a run
# of characters nor recursion: possessive repeats, and starts only at a run's first character or behind a match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
BASE_KINDS = ("email", "ip", "card", "phone")

# FIXED VALUES: further generators.
ADDRESS = r"[^\s@<>]{1,64}@[^\s@<>]{3,255}"
HANDLE = r"[A-Za-z0-9._%+-]{2,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}){1,8}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
NUMBER = r"(?<![0-9A-Za-z])[(0-9][0-9 ().-]{6,30}[0-9]"

#: Words that speak for personal data when they stand before a span.
CONTEXT = {
    "ctx_phone": r"\b(?:phone|tel|call|fax|mobile|cell|telefon|tél|téléphone|teléfono|móvil|handy)",
    "ctx_mail": r"\b(?:e-?mail|mail|contact|correo|courriel|kontakt)",
    "ctx_money": r"\b(?:card|visa|mastercard|iban|account|konto|compte|carte|karte|tarjeta|cuenta|bank|banque|banco)",
    "ctx_id": r"\b(?:ssn|passport|id|ip|address|host|ausweis|passeport|dni)\b",
    "ctx_number": r"\b(?:version|v|page|section|chapter|figure|isbn|order|no|nr|row|total|sum|year)\b",
}

#: A phone word, at most three more words and no digit, up to the span.
PHONE_BEFORE = r"(?:^|[^\p{L}])(?:phone|telephone|tel|call|fax|mobile|cell|telefon|tél|téléphone|teléfono|móvil|handy)\p{L}*(?:[^\p{L}0-9]+\p{L}{1,12}){0,3}[^\p{L}0-9]*$"
#: An area code in brackets, then a number in groups; and what is a date, a decimal number or an IP address instead.
BRACKETED = r"^\(0?[1-9][0-9]{1,4}\) ?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}$"
NOT_NATIONAL = r"^(?:(?:19|20)[0-9]{2}[-. ][01]?[0-9][-. ][0-3]?[0-9]|[0-3]?[0-9][-. ][01]?[0-9][-. ](?:19|20)[0-9]{2}|[0-9]+\.[0-9]+|[0-9]+(?:\.[0-9]+){3})$"

ROUNDS, DEPTH, RATE, RIDGE = 6, 3, 0.5, 1.0
#: Share of selected planted cases, held out of training, that must be right; most selected of the corpus's own candidates
#: that fail their check, as a share of them; planted cases of each generator, a fifth of them held out.
PRECISION, MOST_NATURAL, PLANTED = 0.98, 0.0005, 1000
FURTHER_KINDS = ("address", "handle", "iban", "number")


def matches(text: Column, pattern: str, gate: Column | None = None) -> Column:
    """array<struct<start, end, value, before, after>> of a pattern's leftmost, non-overlapping matches, in code points.

    The text between matches gives their places, and up to 40 characters of context, without another search.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if gate is not None:
        found = F.when(gate, found).otherwise(F.array().cast("array<string>"))

    def ends(hits, gaps):
        sizes = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h))
        return F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))

    def placed(hits, gaps, at):
        return F.transform(hits, lambda h, i: F.struct(
            (at[i + 1] - F.length(h)).cast("long").alias("start"), at[i + 1].cast("long").alias("end"), h.alias("value"),
            F.right(gaps[i], F.lit(40)).alias("before"), F.left(gaps[i + 1], F.lit(8)).alias("after")))

    # Each step is bound once: the engine would evaluate a repeated expression for every match again.
    none = F.array().cast("array<struct<start:long,end:long,value:string,before:string,after:string>>")
    return let(found, lambda hits: F.when(F.size(hits) > 0, let(F.split(text, pattern, -1), lambda gaps: let(
        ends(hits, gaps), lambda at: placed(hits, gaps, at)))).otherwise(none))


def luhn(digits: Column) -> Column:
    def worth(i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.cast("double") <= 255)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _own_check(kind: str, value: Column, before: Column) -> Column:
    """Whether a generator's span is what the generator looks for."""
    if kind in BASE_KINDS:
        return _passes(kind, value)
    if kind == "address":
        return value.rlike(r"^[\p{L}\p{N}._%+'-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,24}[.,;:!?)\]]*$")
    if kind == "handle":
        plain = F.regexp_replace(F.regexp_replace(value, r" ?[(\[]at[)\]] ?", "@"), r" ?(?:[(\[]dot[)\]]|\.) ?", ".")
        return plain.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}$")
    if kind == "iban":
        return iban_ok(F.replace(value, F.lit(" "), F.lit("")))
    size = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return size.between(7, 15) & ~value.rlike(NOT_NATIONAL) & (value.rlike(BRACKETED) | F.lower(before).rlike(PHONE_BEFORE))


def iban_ok(compact: Column) -> Column:
    """ISO 13616: 15 to 34 characters whose number, the first four moved to the end and letters as 10 to 35, is 1 modulo 97."""
    moved = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))

    def step(acc, c):
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.when(F.length(compact).between(15, 34), F.aggregate(F.split(moved, ""), F.lit(0), step) == 1).otherwise(False)


def _gates(text: Column) -> dict[str, tuple[str, Column]]:
    """Pattern of each generator and a cheap test that its texts must pass."""
    at, digit = F.contains(text, F.lit("@")), text.rlike("[0-9]")
    return {"email": (EMAIL, at), "ip": (IP, digit & text.rlike(r"[0-9]\.[0-9]")), "card": (CARD, digit), "phone": (PHONE, F.contains(text, F.lit("+"))),
            "address": (ADDRESS, at), "handle": (HANDLE, text.rlike(r"[(\[]at[)\]]")), "iban": (IBAN, text.rlike("[A-Z]{2}[0-9]{2}")),
            "number": (NUMBER, digit)}


def candidates(docs: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """(k0.., base, other): checked base spans, by kind as listed, then start, and all other proposed spans."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], text.alias("t"))
    gates = _gates(F.col("t"))
    raw = rows.select(*[f"k{i}" for i in range(len(keys))], *[matches(F.col("t"), p, g).alias(k) for k, (p, g) in gates.items()])

    def named(kind):
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    def checked(kind):
        return F.filter(kind, lambda s: _passes(kind, s["value"]))

    raw = raw.select(*[f"k{i}" for i in range(len(keys))], *[checked(k).alias(k) for k in BASE_KINDS],
                     F.concat(*[_with_kind(k) for k in gates]).alias("other"))
    return raw.select(*[f"k{i}" for i in range(len(keys))], F.concat(*[named(k) for k in BASE_KINDS]).alias("base"), "other")


def _with_kind(kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), *[s[f].alias(f) for f in ("start", "end", "value", "before", "after")]))


def _bin(value: Column, *cuts: float) -> Column:
    """Number of cuts that the value reaches."""
    out = F.lit(0)
    for i, c in enumerate(cuts, 1):
        out = F.when(value >= c, i).otherwise(out)
    return out


def features(value: Column, before: Column, after: Column, generator: Column, generators: list[str]) -> dict[str, Column]:
    """Small numbers that describe a span's format and context."""
    digits, letters = F.regexp_count(value, F.lit("[0-9]")), F.regexp_count(value, F.lit(r"\p{L}"))
    last = F.right(before, F.lit(1))
    out = {
        "digits": _bin(digits, 1, 4, 7, 8, 10, 11, 12, 13, 15, 16, 17, 20),
        "letters": _bin(letters, 1, 2, 4, 8, 16),
        "length": _bin(F.length(value), 8, 11, 14, 17, 20, 30, 60),
        "groups": _bin(F.regexp_count(value, F.lit("[0-9A-Za-z]+")), 2, 3, 4, 5, 6, 8),
        "longest_group": _bin(F.array_max(F.transform(F.split(value, "[^0-9A-Za-z]+"), lambda g: F.length(g))), 2, 3, 4, 5, 8, 12, 16),
        "dots": _bin(F.regexp_count(value, F.lit(r"\.")), 1, 2, 3, 4),
        "spaces": _bin(F.regexp_count(value, F.lit(" ")), 1, 2, 3, 4, 6),
        "dashes": _bin(F.regexp_count(value, F.lit("-")), 1, 2, 3, 4),
        "brackets": F.contains(value, F.lit("(")).cast("int"),
        "plus": (F.startswith(value, F.lit("+")) | (last == "+")).cast("int"),
        "at": F.contains(value, F.lit("@")).cast("int"),
        "before": F.when(last == "", 0).when(last.rlike(r"\s"), 1).when(last.rlike(r"[\p{L}0-9]"), 2).otherwise(3),
        "after": F.when(after == "", 0).when(after.rlike(r"^\s"), 1).when(after.rlike(r"^[\p{L}0-9]"), 2).otherwise(3),
        "generator": F.array_position(F.array(*[F.lit(g) for g in generators]), generator).cast("int"),
    }
    low, check = F.lower(before), F.lit(False)
    for kind in generators:
        check = F.when(generator == kind, _own_check(kind, value, before)).otherwise(check)
    out["checked"] = F.coalesce(check, F.lit(False)).cast("int")
    return out | {k: low.rlike(p).cast("int") for k, p in CONTEXT.items()}


def planted_cases(spark, each: int = PLANTED) -> DataFrame:
    """(kind, value, before, after, right, fold): ``each`` cases of every further generator, half of them right.

    All parts are drawn by hashes of the case's number, so the cases are the same on every run.
    """
    def draw(salt: int, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n))

    def one(salt: int, *options) -> Column:
        return F.element_at(F.array(*[o if isinstance(o, Column) else F.lit(o) for o in options]), (draw(salt, len(options)) + 1).cast("int"))

    def digits(salt: int, n: int) -> Column:
        return F.lpad(draw(salt, 10 ** n).cast("string"), n, "0")

    def spaced(compact: Column) -> Column:
        return F.when(draw(90, 2) == 0, compact).otherwise(F.trim(F.regexp_replace(compact, "(.{4})", "$1 ")))

    name = one(1, "jane.doe", "k_müller", "info", "léa", "o'neil", "jo%anna", "m-78", "sales.team", "ñandú")
    host, end = one(2, "mail", "example", "uni-köln", "société", "my-host", "srv2"), one(3, "com", "de", "fr", "org", "museum", "es")
    small = (draw(4, 89) + 10).cast("string")
    address = F.concat(name, F.lit("@"), host, F.lit("."), end)
    not_address = one(5, F.concat(F.lit("odds@"), small, F.lit(":1")), F.concat(name, F.lit("@"), host), F.concat(F.lit("3@"), small, F.lit(",50")),
                      F.concat(name, F.lit("@"), small), F.concat(F.lit("$x@{"), host, F.lit("}")))
    at, dot = one(6, " (at) ", "(at)", " [at] "), one(7, " (dot) ", ".", "[dot]")
    plain = one(8, "jane.doe", "k_muller", "info", "o.neil99", "sales-team")
    handle = F.concat(plain, at, one(9, "mail", "example", "my-host"), dot, one(3, "com", "de", "fr", "org", "net", "es"))
    not_handle = F.concat(one(8, "us", "lunch", "meet.me", "sold", "be"), at, one(10, "noon", "home", "door", "gate"), dot, small)
    country, bban = one(11, "DE", "FR", "ES", "GB", "NL"), F.concat(digits(12, 9), digits(13, 9))
    zero = F.concat(country, F.lit("00"), bban)
    rest = F.aggregate(F.split(F.concat(F.substring(zero, 5, 40), F.substring(zero, 1, 4)), ""), F.lit(0), lambda acc, c: F.when(
        F.ascii(c) >= 65, (acc * 100 + F.ascii(c) - 55) % 97).otherwise((acc * 10 + F.ascii(c) - 48) % 97))
    iban = spaced(F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), bban))
    not_iban = one(14, spaced(F.concat(country, F.lpad(((98 - rest + 1 + draw(15, 80)) % 97).cast("string"), 2, "0"), bban)),
                   F.concat(F.lit("AB"), digits(16, 2), F.lit(" CDEF "), digits(17, 4), F.lit(" "), digits(18, 4)))
    four, three, two = digits(20, 4), digits(21, 3), digits(22, 2)
    number = one(23, F.concat(F.lit("(0"), small, F.lit(") "), four, F.lit(" "), three), F.concat(F.lit("0"), small, F.lit(" "), four, F.lit("-"), three),
                 F.concat(three, F.lit("-"), digits(24, 3), F.lit("-"), four), F.concat(F.lit("06 "), two, F.lit(" "), digits(25, 2), F.lit(" "), digits(26, 2), F.lit(" "), digits(27, 2)),
                 F.concat(F.lit("01"), two, F.lit(" "), digits(28, 7)), F.concat(F.lit("("), (draw(29, 800) + 100).cast("string"), F.lit(") "), three, F.lit("-"), four))
    day, month, year = (draw(30, 28) + 1).cast("string"), (draw(31, 12) + 1).cast("string"), (draw(32, 60) + 1970).cast("string")
    not_number = one(33, F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), F.concat_ws(".", day, month, year), F.concat(small, F.lit("."), digits(34, 6)),
                     F.concat(small, F.lit(" "), three, F.lit(" "), digits(35, 3)), F.concat(four, F.lit(" "), digits(36, 4), F.lit(" "), digits(37, 4)),
                     F.concat(three, F.lit("-"), digits(38, 3)), F.concat(year, F.lit(" - "), (draw(32, 60) + 1975).cast("string")), digits(39, 9), F.concat(two, F.lit(" "), digits(40, 5)))
    cue = {"address": one(50, "write by e-mail to ", "mail: ", "contact "), "handle": one(51, "contact ", "mail me: ", "correo "),
           "iban": one(52, "IBAN ", "to the account ", "Konto "), "number": one(53, "phone ", "call me at ", "tel. ", "Handy: ", "mobile no. ")}
    other = one(54, "and then ", "it was ", "der Rest ", "on ", "", "siehe ", "(", "le ")
    against = one(55, "version ", "order no ", "page ", "section ", "total ", "row ")
    pairs = {"address": (address, not_address), "handle": (handle, not_handle), "iban": (iban, not_iban), "number": (number, not_number)}
    # A bare number in no context tells nothing: a right one has its cue, or an area code in brackets; others have neither.
    rows = spark.range(each * len(pairs)).withColumn("right", F.pmod(F.floor(F.col("id") / len(pairs)), F.lit(2)) == 0)
    kind = F.element_at(F.array(*[F.lit(k) for k in pairs]), (F.pmod("id", F.lit(len(pairs))) + 1).cast("int"))
    value, before = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, (good, bad) in pairs.items():
        here = F.col("kind") == k
        value = F.when(here & F.col("right"), good).when(here, bad).otherwise(value)
        bare = (draw(60, 10) < 4) & ((F.lit(k) != "number") | F.contains(good, F.lit("(")))
        before = F.when(here & F.col("right"), F.when(bare, other).otherwise(cue[k])).when(here, F.when(draw(61, 2) == 0, other).otherwise(against)).otherwise(before)
    rows = rows.withColumn("kind", kind).withColumn("value", value).withColumn("before", before)
    return rows.select("kind", "value", F.concat(one(62, "as we said, ", "", "noch etwas: ", "enfin "), F.col("before")).alias("before"),
                       one(63, ", please", " today", ".", "", ") or so", "\n").alias("after"), "right", F.pmod(F.xxhash64(F.lit(64), "id"), F.lit(5)).alias("fold"))


@dataclass
class Trees:
    """Boosted trees: each a list of (path, value), a path being (feature, cut, above) tests; and the threshold."""
    names: list[str]
    start: float
    trees: list[list[tuple[tuple, float]]]
    threshold: float = math.inf

    def margin(self) -> Column:
        """The score as an expression of the feature columns."""
        out = F.lit(self.start)
        for tree in self.trees:
            out = out + leaf_value(tree)
        return out


def _path(path) -> Column:
    test = F.lit(True)
    for name, cut, above in path:
        test = test & ((F.col(name) > cut) if above else (F.col(name) <= cut))
    return test


def leaf_value(tree) -> Column:
    out = F.lit(0.0)
    for path, value in tree:
        out = F.when(_path(path), value).otherwise(out)
    return out


def boost(table: DataFrame, names: list[str], rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE, ridge: float = RIDGE) -> Trees:
    """Boosted trees for logistic loss on rows (names.., n, positive): counts of candidates by feature vector.

    For each level one grouped sum of gradients by (node, feature, bin) comes to
    the driver, as many rows as nodes times features times bins. The best cut of
    each node is chosen there, ties by name and cut.
    """
    n, positive = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("positive"), F.lit(0))).head()
    if not positive or positive == n:
        return Trees(names, 0.0, [])
    model = Trees(names, math.log(positive / (n - positive)), [])
    for _ in range(rounds):
        p = 1 / (1 + F.exp(-model.margin()))
        rows = table.withColumn("g", F.col("positive") - F.col("n") * p).withColumn("h", F.col("n") * p * (1 - p))
        leaves: list[tuple] = [()]
        done: list[tuple[tuple, float]] = []
        for level in range(depth + 1):
            node = F.lit(-1)
            for i, path in enumerate(leaves):
                node = F.when(_path(path), i).otherwise(node)
            cells = (rows.withColumn("node", node).where("node >= 0")
                     .select("node", "g", "h", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("int").alias("bin")) for f in names])).alias("c"))
                     .groupBy("node", "c.f", "c.bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect())
            following = []
            for i, path in enumerate(leaves):
                mine = sorted((r["f"], r["bin"], r["g"], r["h"]) for r in cells if r["node"] == i)
                if not mine:
                    continue
                total_g = sum(r[2] for r in mine if r[0] == names[0])
                total_h = sum(r[3] for r in mine if r[0] == names[0])
                best = None
                if level < depth:
                    for f in names:
                        g = h = 0.0
                        own = [r for r in mine if r[0] == f]
                        for _, b, dg, dh in own[:-1]:
                            g, h = g + dg, h + dh
                            gain = g * g / (h + ridge) + (total_g - g) ** 2 / (total_h - h + ridge) - total_g ** 2 / (total_h + ridge)
                            if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                                best = (gain, f, b)
                if best:
                    following += [(*path, (best[1], best[2], False)), (*path, (best[1], best[2], True))]
                else:
                    done.append((path, round(rate * total_g / (total_h + ridge), 6)))
            leaves = following
            if not leaves:
                break
        model.trees.append(done)
    return model


def calibrate(model: Trees, planted: DataFrame, natural: DataFrame, precision: float = PRECISION, most: float = MOST_NATURAL) -> float:
    """The lowest margin from which on, of held-out planted cases, the precision holds, and no more than the share ``most`` of
    held-out natural candidates is selected; infinite if there is none.

    Both tables are counts by feature vector (names.., n, positive). Margins are grouped by
    tenths, so few rows come to the driver. Both conditions are shares, so they mean the same at every size.
    """
    def by_step(table: DataFrame) -> dict[int, tuple[int, int]]:
        steps = table.withColumn("step", F.floor(model.margin() * 10)).groupBy("step").agg(F.sum("n").alias("n"), F.sum("positive").alias("p")).collect()
        return {r["step"]: (r["n"], r["p"]) for r in steps}

    cases, own = by_step(planted), by_step(natural)
    every = sum(n for n, _ in own.values())
    n = positive = selected = 0
    threshold = math.inf
    for step in sorted(cases.keys() | own.keys(), reverse=True):
        n, positive = n + cases.get(step, (0, 0))[0], positive + cases.get(step, (0, 0))[1]
        selected += own.get(step, (0, 0))[0]
        if selected > most * every:
            break
        if n and positive >= precision * n:
            threshold = step / 10
    return threshold


def train(natural: DataFrame, names: list[str], generators: list[str], planted: int = PLANTED) -> Trees:
    """Trees and threshold from planted cases and the corpus's own failing candidates (held, names.., n: counts by feature vector).

    Planted cases weigh as much together as the natural ones that are trained on, whatever the size of the corpus.
    """
    spark = natural.sparkSession
    cases = planted_cases(spark, planted)
    named = features(F.col("value"), F.col("before"), F.col("after"), F.col("kind"), generators)
    cases = stored(cases.select((F.col("fold") == 0).alias("held"), F.col("right").cast("long").alias("positive"), *[c.cast("int").alias(k) for k, c in named.items()])
                   .groupBy("held", *names).agg(F.count("*").alias("n"), F.sum("positive").alias("positive")), "pii-planted")
    natural = natural.withColumn("positive", F.lit(0).cast("long"))
    own, made = natural.where("not held").agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0], cases.where("not held").agg(F.sum("n")).head()[0]
    weight = max(1, own // made)
    learnt = cases.where("not held").select(*names, (F.col("n") * weight).alias("n"), (F.col("positive") * weight).alias("positive"))
    model = boost(learnt.unionByName(natural.where("not held").select(*names, "n", "positive")), names)
    model.threshold = calibrate(model, cases.where("held"), natural.where("held"))
    return model


def planted_recall(spark, model: Trees, generators: list[str], planted: int = PLANTED) -> DataFrame:
    """(kind, right, cases, found): held-out planted cases by generator, and how many the threshold selects."""
    cases = planted_cases(spark, planted).where("fold = 0")
    named = features(F.col("value"), F.col("before"), F.col("after"), F.col("kind"), generators)
    scored = cases.select("kind", "right", *[c.cast("int").alias(k) for k, c in named.items()])
    return scored.groupBy("kind", "right").agg(F.count("*").alias("cases"), F.count_if(model.margin() >= model.threshold).alias("found"))


GENERATORS = [*BASE_KINDS, *FURTHER_KINDS]


def scored_candidates(docs: DataFrame, keys: list[str], text_col: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """(spans by row, a row a candidate with its features, the features' names), both stored."""
    proposed = stored(candidates(docs, keys, text_col).withColumn("row", F.monotonically_increasing_id()), "pii")
    each = proposed.where(F.size("other") > 0).select("row", "k0", "base", F.explode("other").alias("s"))
    overlaps = F.exists("base", lambda b: (b["start"] < F.col("s.end")) & (F.col("s.start") < b["end"]))
    named = features(F.col("s.value"), F.col("s.before"), F.col("s.after"), F.col("s.kind"), GENERATORS)
    fold = F.pmod(F.xxhash64("k0", "s.value", "s.before"), F.lit(5))            # of the text alone, whatever the splits
    scored = stored(each.select("row", fold.alias("fold"), F.col("s.kind").alias("kind"), F.col("s.start").alias("start"), F.col("s.end").alias("end"),
                                overlaps.alias("covered"), *[c.cast("int").alias(k) for k, c in named.items()]), "pii-features")
    return proposed, scored, sorted(named)


def natural_counts(scored: DataFrame, names: list[str]) -> DataFrame:
    """(held, names.., n) of the corpus's candidates that fail their check and lie on no base span; stored."""
    own = scored.where(~F.col("covered") & (F.col("checked") == 0))
    return stored(own.groupBy((F.col("fold") == 0).alias("held"), *names).agg(F.count("*").alias("n")), "pii-vectors")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, keys, base and found (arrays of kind, start, end; found adds the selected spans).

    Spans are in code points, ends exclusive, by kind as listed, then start. A null
    or empty text has no spans; null and repeated ids keep their rows; an empty
    table gives no rows; other columns are not read. Spans beyond the base kinds are those that overlap no base span and
    whose score reaches the calibrated threshold.
    """
    keys = list(dict.fromkeys([id_col, *(keys or [])]))
    own = [f"k{i}" for i in range(len(keys))]
    proposed, scored, names = scored_candidates(docs, keys, text_col)
    model = train(natural_counts(scored, names), names, GENERATORS)
    none = F.array().cast("array<struct<kind:string,start:long,end:long>>")
    rank = {g: i for i, g in enumerate(GENERATORS)}
    extra = (scored.where(~F.col("covered")).withColumn("margin", model.margin()).where(F.col("margin") >= model.threshold)
             .groupBy("row").agg(F.collect_set(F.struct("checked", "margin", "kind", "start", "end")).alias("more")))
    # Of overlapping spans one that passes its check stays, then the one with the best score, then the longest, the first, the first kind.
    def better(a, b):
        order = F.map_from_arrays(F.array(*[F.lit(k) for k in rank]), F.array(*[F.lit(v) for v in rank.values()]))
        left = F.struct(a["checked"], a["margin"], a["end"] - a["start"], -a["start"], -order[a["kind"]])
        right = F.struct(b["checked"], b["margin"], b["end"] - b["start"], -b["start"], -order[b["kind"]])
        return left > right
    kept = F.filter("more", lambda s: ~F.exists("more", lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]) & better(o, s)))
    kept = F.transform(kept, lambda s: F.struct(F.concat(F.lit("like_"), s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    rows = proposed.select("row", *own, "base").join(extra.select("row", kept.alias("more")), "row", "left").withColumn("more", F.coalesce("more", none))
    more = F.array_sort("more", lambda a, b: F.when((a["kind"] < b["kind"]) | ((a["kind"] == b["kind"]) & (a["start"] < b["start"])), -1)
                        .when((a["kind"] == b["kind"]) & (a["start"] == b["start"]), 0).otherwise(1))
    return rows.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "base", F.concat("base", more).alias("found"))


def span_text(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def digest() -> list[Column]:
    """n_<kind>, base_sha256 and spans from base and found."""
    return [*[_count(k) for k in BASE_KINDS], F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("found").alias("spans")]


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans leave the first one's mark."""
    in_order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, mark)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(in_order, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in the text; all rows and columns stay.

    Where there is a column ``length_col`` it gets the length of a changed text.
    A null text stays null. ``docs`` is read once: spans and rows meet by a row
    number that is stored with the rows.
    """
    key = "__llm_row"
    rows = numbered(docs, key)
    found = find_personal_data(rows, id_col, text_col, keys=[key]).where(F.size("found") > 0).select(key, F.col("found").alias("__llm_found"))
    joined = rows.join(found, key, "left")
    text = F.col(text_col)
    new = F.when(F.col("__llm_found").isNotNull() & text.isNotNull(), redacted(text, F.col("__llm_found"))).otherwise(text)
    out = joined.withColumn("__llm_new", new)
    cols = [F.col("__llm_new").alias(c) if c == text_col
            else F.when(F.col("__llm_found").isNotNull(), F.length("__llm_new")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c)
            if c == length_col else F.col(c) for c in docs.columns]
    return out.select(*cols)
