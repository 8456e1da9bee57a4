"""Personal data by candidate gradient boosting, with DataFrame functions only.

Base rules find e-mail addresses, IP addresses, card and phone numbers by format
and check (octets, Luhn, number of digits). Beside them, high-recall generators
propose overlapping spans: things with an at-sign in any spelling, runs of seven
or more digits, long mixed tokens. Boosted trees score each proposal from its
format and its surroundings, and only their calibrated thresholds select.

Labels come from evidence that no feature holds: worked examples (``EXAMPLES``, judged by
hand, with digits and letters drawn per example) and, in the corpus, check digits and octet
ranges of numbers that have the form of a card or an address. All other proposals of the
corpus have no label. Format and surroundings are cut into few levels, so all labelled
proposals of all texts are counted per combination of levels, and the trees are fitted to
these counts (there are at most as many as combinations, ``COMBINATIONS``); the corpus is
scaled to the weight of the examples, so that tables of every size are judged alike.
Examples and proposals are parted in two halves (proposals by a hash of their text). Each
half has its own trees, whose thresholds are set on the other half: per generator the lowest
score, ``LEAST`` or more, from which on proposals are right often enough. A proposal is selected if the trees of either
half put it at or above their threshold.

The trees become SQL expressions; texts never leave the JVM. All positions are
code points, ends exclusive. Patterns are possessive and anchored to the start of
a run, so that long runs take linear time and no recursion.

Defined results: null and empty texts have no spans; an empty table gives no rows.
Base spans always stay. Repeated rows give repeated results. Other columns of the
input are not read, or kept unchanged by :func:`redacted`.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


LOCAL = r"[A-Za-z0-9._%+-]"
#: Base kinds in the order of results: pattern, then what a match must pass.
BASE: dict[str, str] = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP_VALID = rf"^(?:{OCTET.replace('*+', '*')}\.){{3}}{OCTET.replace('*+', '*')}$"
IP_INSIDE = IP_VALID.replace("^", "(?<![0-9.])").replace("$", "(?![0-9.])")

#: Generators of proposals.
GENERATORS: dict[str, str] = {
    "contact": rf"(?<!{LOCAL}){LOCAL}++(?:@| ?[\[({{] ?(?:at|AT|@) ?[\])}}] ?)[A-Za-z0-9-]++(?:(?:\.| ?[\[({{] ?(?:dot|DOT|\.) ?[\])}}] ?)[A-Za-z0-9-]++)*+",
    "number": r"(?<![0-9A-Za-z])[+(]{0,2}+[0-9](?:[ ().:/-]{0,2}+[0-9]){6,}+",
    "secret": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+",
}
#: Words just before a proposal, by what they announce.
CUES = ("e-?mails?|mailto|contact", "phone|telephone|tel|call|fax|mobile|cell", "card|visa|account|iban", "host|addr|ip", "key|token|secret|passw|credential")
CUE_CHARS = 24
#: Characters that may stand between such a word and what it announces.
FILLER = r"[^0-9a-z]*(?:(?:me|us|at|on|to|is|number|no|nr|address)\b[^0-9a-z]*)*$"
FEATURES = ("gen", "digits", "size", "marks", "lead", "left", "right", "cue")
LEVELS = (3, 6, 4, 6, 4, 4, 4, 6)
#: Formats with a level of their own: spelled addresses, and digits in groups that are no dates or years.
AT_SIGN, DOT_SIGN = r" ?[\[({] ?(?:at|AT|@) ?[\])}] ?", r" ?[\[({] ?(?:dot|DOT|\.) ?[\])}] ?"
SPELLED = rf"^{LOCAL}+(?:@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?:{DOT_SIGN})|{AT_SIGN}[A-Za-z0-9-]+(?:\.|{DOT_SIGN}))(?:[A-Za-z0-9-]+(?:\.|{DOT_SIGN}))*[A-Za-z]{{2,24}}$"
GROUPED = r"^(?=.*[(./-]|0)(?:\+?[0-9]{1,3}[ .-])?(?:\([0-9]{2,5}\)[ .-]?|[0-9]{2,5}[ ./-])[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}$"
SHORT_GROUPED = r"^[0-9]{3}[.-][0-9]{4}$"
DATED = r"^(?:(?:19|20)[0-9]{2}[ ./-][01]?[0-9][ ./-][0-3]?[0-9](?:[ .:/-]|$)|[0-3]?[0-9][ ./-][0-3]?[0-9][ ./-](?:19|20)[0-9]{2}(?:[ .:/-]|$)|(?:(?:19|20)[0-9]{2}[ ./-]*)+$|[0-9]+(?:\.[0-9]+){3}$)"
COMBINATIONS = math.prod(LEVELS) * 4
ROUNDS, RATE, PRECISION = 40, 0.3, 0.9
LEAST = 0.8
#: Weight of a worked example; a corpus weighs no more than all examples together.
EXAMPLE_WEIGHT = 10
#: Worked examples: generator, text with the proposal in «», whether it is to be redacted. ``#`` stands
#: for a digit, ``~`` for a letter, ``^`` for a letter of either case or a digit, ``%`` for a hexadecimal digit.
EXAMPLES = (
    ("contact", "see «~~~~# [at] ~~~~~~~ [dot] com» end", True), ("contact", "«~~~~~ (at) ~~~~.~~~»", True),
    ("contact", "reach «~~~~.~~~[at]~~~~~~[dot]org», please", True), ("contact", "write to «~~~@~~~~~~ [dot] net» now", True),
    ("contact", "via «~~~~##{at}~~~~~.~~~~~~~.com» or", True), ("contact", "email: «~~~~#@~~~~~~~~~» end", True),
    ("contact", "contact «~~~~@~~~~~»", True), ("contact", "E-Mail: «~~~~~~~~~~~~~##@~~~~~~~~» end", True),
    ("contact", "from «~~~~~.##@~~~~#.~~~~~~~.com» to", True), ("contact", "<«~~~@~~~~~~.org»>", True),
    ("contact", "run «~~~@~~~~~~» here", False), ("contact", "«~~~~@~~~~»:~$ ls", False), ("contact", "look «~~~~ (at) ~~~~» and", False),
    ("contact", "buy «#@#» each", False), ("contact", "see «~~~#@~~~~~~~~~~» there", False), ("contact", "clone '«~~~@~~~~~~~~~~~~~~~~~~~»'", False),
    ("number", "see «(4##) 555-2###» end", True), ("number", "see «3##-555-1###» end", True), ("number", "or «555-1###», say", True),
    ("number", "at «+44 20 7### 0###» today", True), ("number", "under «0151 2### 6###»", True), ("number", "dial «01 2# 4# 6# 8#» please", True),
    ("number", "phone: «4155552###» end", True), ("number", "call me at «0301234###».", True), ("number", "Tel. «2#5##7#9»", True),
    ("number", "fax no «49891234####» end", True), ("number", "mobile: «+49891234567##», yes", True), ("number", "from «+1 (8##) 555-4###» on", True),
    ("number", "phone no. «4## 55 6###»", True), ("number", "number is «+1-4##-555-0###»", True),
    ("number", "on «2024-01-1# 10:2#» or", False), ("number", "or «15.01.20##» in", False), ("number", "in «2019 2020 202#» or", False),
    ("number", "or «1#3#5#7#9#» of", False), ("number", "order «9#8#7#6#5»", False), ("number", "pi is «3.1#1#9#6#» or", False),
    ("number", "at «10:22:3#.1##», then", False), ("number", "«2024-01-1# 10:2#:3#» start", False), ("number", "took «0:0#:1#.25####» in", False), ("number", "id «#######4#####4##» and", False), ("number", "«75367#4127#130## 48451#8114#073##» und", False),
    ("number", 'token = "«18#6#1#56»abcdef#a#b"', False), ("number", "of «1##### 2#####» rows", False), ("number", "«12/0#/2021 1#:30» or", False),
    ("number", "row «#######»", False), ("number", "sum «1##.###.###» in", False), ("number", "code «########################»", False),
    ("secret", 'the token = "«%%%%a%%%%%%%%1%%%%%%%%%%%%%%%%%%%%%%%%%%»" end', True), ("secret", "api key = «^^#^~^^^^^#^^^^^^^^^^^»", True),
    ("secret", "password: «^^^#^^^~^^^^#^^^^^^^^^^^^^»,", True), ("secret", 'SECRET="«~^^^^^^^^^#^^^^^^^^^^^^^^^^^^^^^^^^^^^^»"', True),
    ("secret", "access_key=«^^^^#^^^/^^^^^^~^^^^+^^^^^^^^^^^^^^^^^^^»", True), ("secret", "credentials '«%%%%%1%%%%%%a%%%%%%%%%%%%%%%%%%»'", True),
    ("secret", "TOKEN: «#########~~~~~########» or", True), ("secret", "see «~~~#~~~~~~~~~~~#~~~~~~~~~~» and", False),
    ("secret", "commit «%%%%1%%%%%%a%%%%%%%%%%%%%%%%%%%%%%%%%%%%» of", False), ("secret", "in /«~~~~~~/~~~~~~~/2024/~~~~~»/", False),
    ("secret", "the «~~~~~-~~~~~~~-v#-~~~~~-20##» model", False), ("secret", "«~~~~_2024_01_1#_~~~~~~»", False),
    ("secret", "(«%%%%%%%%1%%%%%%a%%%%%%%%%%%%%%%%»)", False), ("secret", '"«%%%a%%%1%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%»"', False),
)
DRAWS = 6


def examples() -> list[tuple[str, str, str, bool, int]]:
    """(generator, text, proposal, label, half) of all worked examples, drawn with a fixed seed."""
    rng = random.Random(7)
    kinds = {"#": "0123456789", "~": "abcdefghijklmnopqrstuvwxyz", "^": "abcdefghjkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789", "%": "0123456789abcdef"}
    out = []
    for gen, form, label in EXAMPLES:
        for draw in range(DRAWS):
            text = "".join(rng.choice(kinds[c]) if c in kinds else c for c in form)
            inner = text[text.index("«") + 1 : text.index("»")]
            out.append((gen, text.replace("«", "").replace("»", ""), inner, label, draw % 2))
    return out


def _running(gaps: Column) -> Column:
    """Starts of the matches from (gap before, size); blocks keep the work near linear."""
    zero = F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("s"))
    width = 256

    def block(b):
        return F.aggregate(
            F.slice(gaps, b + 1, width),
            zero,
            lambda a, x: F.struct((a["pos"] + x["gap"] + x["size"]).alias("pos"), F.concat(a["s"], F.array(a["pos"] + x["gap"])).alias("s")),
        )

    blocks = F.transform(F.sequence(F.lit(0), F.size(gaps) - 1, F.lit(width)), block)
    return F.aggregate(blocks, zero, lambda a, b: F.struct((a["pos"] + b["pos"]).alias("pos"), F.concat(a["s"], F.transform(b["s"], lambda x: x + a["pos"])).alias("s")))["s"]


NONE = "array<struct<start:int,end:int,text:string,before:string,after:string>>"


def located(df: DataFrame, text: str, patterns: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds, per name, all leftmost non-overlapping matches: array of (start, end, text, before, after).

    ``before`` and ``after`` are the nearest characters up to the neighbouring
    matches; they come from the gaps, so that no match searches the whole text.
    A pattern comes with a condition without which no match can exist.
    """
    names = list(patterns)
    none = F.array().cast("array<string>")
    df = df.select("*", *[F.when(needs, F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0))).otherwise(none).alias(f"__m_{n}") for n, (p, needs) in patterns.items()])
    gaps = [
        F.when(
            F.size(f"__m_{n}") > 0,
            F.transform(F.split(F.col(text), patterns[n][0], -1), lambda g: F.struct(F.length(g).alias("size"), F.substring(g, -CUE_CHARS, CUE_CHARS).alias("last"), F.substring(g, 1, 1).alias("first"))),
        ).alias(f"__g_{n}")
        for n in names
    ]
    df = df.select("*", *gaps)
    sizes = [
        F.when(
            F.col(f"__g_{n}").isNotNull(),
            F.zip_with(F.slice(f"__g_{n}", 1, F.size(f"__m_{n}")), f"__m_{n}", lambda g, m: F.struct(g["size"].alias("gap"), F.length(m).alias("size"))),
        ).alias(f"__z_{n}")
        for n in names
    ]
    df = df.select("*", *sizes)
    df = df.select("*", *[F.when(F.col(f"__z_{n}").isNotNull(), _running(F.col(f"__z_{n}"))).alias(f"__s_{n}") for n in names])

    def joined(n):
        start, match, gap = F.col(f"__s_{n}"), F.col(f"__m_{n}"), F.col(f"__g_{n}")
        near = F.zip_with(F.slice(gap, 1, F.size(match)), F.slice(gap, 2, F.size(match)), lambda a, b: F.struct(a["last"].alias("before"), b["first"].alias("after")))
        placed = F.zip_with(start, match, lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("text")))
        return F.zip_with(placed, near, lambda p, q: F.struct(p["start"].alias("start"), p["end"].alias("end"), p["text"].alias("text"), q["before"].alias("before"), q["after"].alias("after")))

    spans = [F.coalesce(F.when(F.col(f"__s_{n}").isNotNull(), joined(n)), F.array().cast(NONE)).alias(n) for n in names]
    return df.select(*[c for c in df.columns if not c.startswith(("__m_", "__g_", "__z_", "__s_"))], *spans)


def _valid(kind: str, span: Column) -> Column:
    text = span["text"]
    if kind == "ip":
        return text.rlike(IP_VALID)
    digits = F.regexp_replace(text, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", F.when(F.length(digits) <= 19, digits).otherwise(F.lit("")))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _check(kind: str):
    return lambda span: _valid(kind, span)


def _kinded(kind: str):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))


def _found(df: DataFrame, text: str) -> DataFrame:
    """Adds arrays of valid base spans and of proposals to rows with ``text``."""
    df = df.withColumn("__digit", F.col(text).rlike("[0-9]"))
    at, digit = F.col(text).contains("@"), F.col("__digit")
    spelled = F.col(text).rlike(r"@|[\[({] ?(?:at|AT)")
    needs = {"email": at, "ip": digit, "card": digit, "phone": digit & F.col(text).contains("+"), "contact": spelled, "number": digit, "secret": digit}
    every = {n: (p, F.coalesce(needs[n], F.lit(False))) for n, p in (BASE | GENERATORS).items()}
    df = located(df, text, every)
    return df.withColumns({k: F.filter(k, _check(k)) for k in BASE}).drop("__digit")


def _level(value: Column, *bounds: int) -> Column:
    out = F.lit(len(bounds))
    for i in range(len(bounds) - 1, -1, -1):
        out = F.when(value <= bounds[i], F.lit(i)).otherwise(out)
    return out


def _proposals(df: DataFrame) -> DataFrame:
    """Adds ``proposals``: spans with the levels of their features.

    ``within`` says that the proposal is itself a base match, and so no addition. ``checked`` is
    the verdict of check digits or octet ranges, null where there is nothing to check.
    """
    arrays = []
    for g, name in enumerate(GENERATORS):

        def described(s):
            said = s["text"]
            n_digits = F.length(F.regexp_replace(said, "[^0-9]", ""))
            before = F.lower(s["before"])
            cue = F.lit(0)
            for i, words in reversed(list(enumerate(CUES))):
                told = rf"(?<![a-z])(?:{words})" + ("" if i + 1 == len(CUES) else rf"\b{FILLER}")
                cue = F.when(before.rlike(told), F.lit(i + 1)).otherwise(cue)
            left, right = F.substring(s["before"], -1, 1), s["after"]

            def side(c):
                return F.when((c == "") | c.rlike(r"^\s$"), 0).when(c.rlike("^[A-Za-z0-9]$"), 1).when(c.rlike("^[\"'=:(\\[<]$"), 2).otherwise(3)

            grouped = (said.rlike(GROUPED) | said.rlike(SHORT_GROUPED)) & ~said.rlike(DATED) & n_digits.between(7, 15)
            marks = F.when(grouped, 4).when(said.rlike(SPELLED), 5).when(~said.rlike("[ ().:/-]"), 0).when(~said.rlike("[().:/]"), 2).when(~said.rlike("[ ():/-]"), 3).otherwise(1)
            lead = F.when(said.rlike("^[0-9]"), 0).when(said.rlike("^[A-Za-z]"), 1).when(said.startswith("+"), 2).otherwise(3)
            within = F.lit(False)
            for kind in {"contact": ("email",), "number": ("ip", "card", "phone")}.get(name, ()):
                within = within | (said.rlike(f"^(?:{BASE[kind]})$") & F.coalesce(_valid(kind, s), F.lit(False)))
            checked = F.lit(None).cast("boolean")
            if name == "number":
                for kind in ("card", "ip"):
                    shaped = said.rlike(f"^(?:{BASE[kind]})$") & (n_digits.between(16, 19) if kind == "card" else F.lit(True))
                    checked = F.when(shaped, F.coalesce(_valid(kind, s), F.lit(False))).otherwise(checked)
            return F.struct(
                F.lit(g).alias("gen"), s["start"].alias("start"), s["end"].alias("end"), said.alias("text"), within.alias("within"),
                checked.alias("checked"),
                _level(n_digits, 0, 7, 12, 15, 19).alias("digits"), _level(F.length(said), 11, 19, 31).alias("size"),
                marks.alias("marks"), lead.alias("lead"), side(left).alias("left"), side(right).alias("right"),
                cue.alias("cue"),
            )

        source = F.filter(name, lambda s: s["text"].rlike("[0-9]") & s["text"].rlike("[A-Za-z]")) if name == "secret" else F.col(name)
        arrays.append(F.transform(source, described))
    return df.withColumn("proposals", F.concat(*arrays)).drop(*GENERATORS)


@dataclass
class Trees:
    """Boosted trees of depth two, and per generator the least score that is selected."""

    start: float
    splits: list[tuple]
    thresholds: list[float]

    def score(self, levels: tuple[int, ...]) -> float:
        z = self.start
        for f, t, low, high in self.splits:
            g, u, a, b = low if levels[f] <= t else high
            z += a if levels[g] <= u else b
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def column(self, p: Column) -> Column:
        """The score of a proposal as an expression."""
        z = F.lit(self.start)
        for f, t, low, high in self.splits:
            low_leaf, high_leaf = (F.when(p[FEATURES[g]] <= u, F.lit(a)).otherwise(F.lit(b)) for g, u, a, b in (low, high))
            z = z + F.when(p[FEATURES[f]] <= t, low_leaf).otherwise(high_leaf)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))

    def margin(self, p: Column, score: Column) -> Column:
        """How far a score is above the threshold of its generator; selected from 0 on."""
        return score - F.element_at(F.array(*[F.lit(t) for t in self.thresholds]), p["gen"] + 1)


def _best_split(rows: list[tuple], residual: list[float], hessian: list[float], inside: list[int]) -> tuple[float, tuple]:
    """(gain, (feature, level, leaf at most, leaf above)) over the rows ``inside``."""
    g, h = sum(residual[i] for i in inside), sum(hessian[i] for i in inside)
    best = (0.0, (0, LEVELS[0], g / (h + 1), 0.0))
    for f, n in enumerate(LEVELS):
        by_g, by_h = [0.0] * n, [0.0] * n
        for i in inside:
            by_g[rows[i][f]] += residual[i]
            by_h[rows[i][f]] += hessian[i]
        a_g = a_h = 0.0
        for t in range(n - 1):
            a_g, a_h = a_g + by_g[t], a_h + by_h[t]
            gain = a_g**2 / (a_h + 1) + (g - a_g) ** 2 / (h - a_h + 1) - g**2 / (h + 1)
            if gain > best[0] + 1e-9:
                best = (gain, (f, t, a_g / (a_h + 1), (g - a_g) / (h - a_h + 1)))
    return best


def boost(counts: list[tuple[tuple[int, ...], float, float]], rounds: int = ROUNDS, rate: float = RATE) -> Trees:
    """Logistic boosting on (levels, proposals, true ones); thresholds are left open."""
    rows, n, pos = [c[0] for c in counts], [c[1] for c in counts], [c[2] for c in counts]
    start = math.log((sum(pos) + 1) / (sum(n) - sum(pos) + 1))
    z, splits = [start] * len(rows), []
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) for x in z]
        residual = [y - k * q for y, k, q in zip(pos, n, p, strict=True)]
        hessian = [k * q * (1 - q) for k, q in zip(n, p, strict=True)]
        gain, (f, t, _, _) = _best_split(rows, residual, hessian, list(range(len(rows))))
        if gain <= 1e-6:
            break
        halves = []
        for side in (True, False):
            inside = [i for i in range(len(rows)) if (rows[i][f] <= t) == side]
            g, u, a, b = _best_split(rows, residual, hessian, inside)[1]
            halves.append((g, u, rate * a, rate * b))
        splits.append((f, t, halves[0], halves[1]))
        for i, levels in enumerate(rows):
            g, u, a, b = halves[0] if levels[f] <= t else halves[1]
            z[i] += a if levels[g] <= u else b
    return Trees(start, splits, [2.0] * len(GENERATORS))


def thresholds(scored: list[tuple[int, float, int, int]], precision: float = PRECISION) -> list[float]:
    """Per generator, from (generator, score, proposals, true ones), the lowest score above which proposals are right often enough.

    There is no least number of proposals, and no score below ``LEAST``. Where
    none is right often enough, 2.0 stands for no score at all.
    """
    out = []
    for g in range(len(GENERATORS)):
        own = sorted((x[1:] for x in scored if x[0] == g and x[1] >= LEAST), reverse=True)
        total = right = 0
        threshold = 2.0
        for i, (score, n, pos) in enumerate(own):
            total, right = total + n, right + pos
            if (i + 1 == len(own) or own[i + 1][0] < score) and right / total >= precision:
                threshold = score - 1e-9
        out.append(threshold)
    return out


def calibrate(trees: Trees, held: list[tuple[tuple[int, ...], int, int]], precision: float = PRECISION) -> Trees:
    """The trees with thresholds from proposals that they were not fitted to."""
    return Trees(trees.start, trees.splits, thresholds([(levels[0], trees.score(levels), n, pos) for levels, n, pos in held], precision))


def cross_fitted(halves: list[list[tuple[tuple[int, ...], float, float]]], precision: float = PRECISION) -> list[Trees]:
    """The trees of each half, with thresholds from the other one."""
    return [calibrate(boost(halves[k]), halves[1 - k], precision) for k in (0, 1)]


def train(df: DataFrame, text_col: str = "text", precision: float = PRECISION) -> list[Trees]:
    """Count labelled proposals by combination of levels; fit and calibrate on both halves."""
    worked = df.sparkSession.createDataFrame(examples(), "told string, t string, said string, label boolean, half int")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in worked.schema if f.name != "t"]
    texts = df.select(F.col(text_col).alias("t"), *nothing).unionByName(worked)
    read = _proposals(_found(texts, "t")).select("told", "said", "label", "half", F.explode("proposals").alias("p"))
    names = F.array(*[F.lit(g) for g in GENERATORS])
    taught = F.when((F.element_at(names, F.col("p.gen") + 1) == F.col("told")) & (F.col("p.text") == F.col("said")), F.col("label"))
    half = F.coalesce("half", F.pmod(F.xxhash64("p.text"), F.lit(2)).cast("int"))
    counted = (
        read.select(half.alias("half"), F.col("told").isNotNull().alias("taught"), F.when(F.col("told").isNull(), F.col("p.checked")).otherwise(taught).alias("label"), *[F.col(f"p.{f}").alias(f) for f in FEATURES])
        .where(F.col("label").isNotNull())
        .groupBy("half", "taught", *FEATURES)
        .agg(F.count("*").alias("n"), F.sum(F.col("label").cast("int")).alias("pos"))
        .collect()
    )
    halves = []
    for k in (0, 1):
        mine = [r for r in counted if r["half"] == k]
        weight = {t: sum(r["n"] for r in mine if r["taught"] == t) for t in (True, False)}
        scale = {True: EXAMPLE_WEIGHT, False: min(EXAMPLE_WEIGHT, EXAMPLE_WEIGHT * weight[True] / max(weight[False], 1))}
        sums: dict[tuple[int, ...], list[float]] = {}
        for r in sorted(mine, key=lambda r: (r["taught"], *[r[f] for f in FEATURES])):
            own = sums.setdefault(tuple(r[f] for f in FEATURES), [0.0, 0.0])
            own[0] += scale[r["taught"]] * r["n"]
            own[1] += scale[r["taught"]] * r["pos"]
        halves.append([(levels, n, pos) for levels, (n, pos) in sorted(sums.items())])
    return cross_fitted(halves, precision)


def _selected(df: DataFrame, text: str, trees: list[Trees]) -> DataFrame:
    """Adds ``base`` and ``extra``: arrays of (kind, start, end), extra also with ``score``, its best one."""
    df = _proposals(_found(df, text))
    base = F.concat(*[F.transform(k, _kinded(k)) for k in BASE])
    kinds = F.array(*[F.lit(g) for g in GENERATORS])

    def scored(p):
        scores = F.array(*[t.column(p) for t in trees])
        margins = F.zip_with(scores, F.array(*[t.margin(p, F.lit(0.0)) for t in trees]), lambda a, b: a + b)
        return F.struct(F.element_at(kinds, p["gen"] + 1).alias("kind"), p["start"].alias("start"), p["end"].alias("end"), F.array_max(scores).alias("score"), F.array_max(margins).alias("margin"))

    every = F.transform(F.filter("proposals", lambda p: ~p["within"]), scored)
    return df.withColumn("base", base).withColumn("extra", F.filter(every, lambda p: p["margin"] >= 0))


def find_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", trees: list[Trees] | None = None) -> DataFrame:
    """Per input row: id, ``base`` spans and ``extra`` spans that the trees select."""
    trees = trees or train(df, text_col)
    named = df.select(F.col(id_col).alias("__llm_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return _selected(named, "t", trees).select(F.col("__llm_id").alias(id_col), "base", F.transform("extra", lambda p: p.dropFields("margin")).alias("extra"))


def redacted(df: DataFrame, text_col: str = "text", length_col: str | None = None, trees: list[Trees] | None = None) -> DataFrame:
    """The rows of ``df``, all columns kept, with every span replaced by its kind in brackets.

    Overlapping spans become one, named after the first. ``length_col``, if given,
    gets the new number of characters where the text has changed. Null stays null.
    """
    trees = trees or train(df, text_col)
    rows = df.select(F.struct(*df.columns).alias("__llm_row"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    spans = F.array_sort(F.concat(*[F.transform(c, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind"))) for c in ("base", "extra")]))
    begin = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))

    def step(a, s):
        clear = s["start"] >= a["pos"]
        piece = F.concat(F.substring(F.col("t"), a["pos"] + 1, s["start"] - a["pos"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(a["pos"], -s["end"]).alias("pos"), F.when(clear, F.concat(a["out"], F.array(piece))).otherwise(a["out"]).alias("out"))

    found = _selected(rows, "t", trees).select("__llm_row", "t", spans.alias("s"))
    told = found.withColumn("r", F.when(F.size("s") > 0, F.aggregate("s", begin, step)))
    clean = F.when(F.size("s") > 0, F.concat(F.array_join("r.out", ""), F.expr("substring(t, r.pos + 1)")))
    told = told.select("__llm_row", clean.alias("c"))
    out = []
    for c in df.columns:
        old = F.col("__llm_row").getField(c)
        new = F.coalesce("c", old) if c == text_col else F.coalesce(F.length("c").cast(df.schema[c].dataType), old) if c == length_col else old
        out.append(new.alias(c))
    return told.select(*out)


def digest(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")



def number_of(kind: str, spans: str = "base") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))
