"""Chat formatting: roles recovered by a hidden Markov model, then canonical turns.

Every line of a conversation's messages is one observation: a speaker marker ("User:",
"Q:", "### Assistant"), its length, its number in the message, a question mark. The roles
are the hidden states; they pass on in one way from message to message, in another from
line to line of a message, and in a third where a marker stands inside a message. Viterbi
finds the likeliest roles of the whole conversation, so one message can hold several
speakers. Neighbouring lines of one role are rendered as one canonical turn.

The best path is found in pieces, so a conversation of any length is spread over
many tasks: a chunk of messages with their lines is summed up as the matrix of its best path scores
from each first to each last role (max-plus products are associative); a pass over
these matrices, one per chunk, fixes the first and last role of each chunk; inside
the chunk the rest follows. The result is that of one long Viterbi pass.

Defined results: messages are ordered by turn (null last), then by a hash of the
text, then by the text; equal messages follow each other. Rows with a null
conversation id are one conversation. A null text is one empty line and is rendered
as an empty turn. Only a marker that opens a part is taken off, with one blank after it, and
only where the line gets the marker's role; every other character stays, indents, tables, lists
and outer blanks among them (but see ``chat_turns`` on forged turns). In the
estimates a line has the role of the last marker at or above it in its message, else
the message's; first roles count once a conversation, successions also across chunks. Ties go to the role that comes first in ``ROLES``. Rows whose
role is unknown to ``ROLES`` do not take part in the estimates; without any known
role the given priors alone decide. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractcheck.functions.lineage import settled

ROLES = ("system", "user", "assistant")
#: Words of speaker markers per role, those that name a speaker and those that
#: are as often a label, a heading or an item of a list.
SPEAKERS = (("system", "sys"), ("user", "human"), ("assistant", "ai", "bot", "gpt"))
LABELS = (("instruction", "instructions"), ("question", "q", "customer", "you", "me", "prompt"), ("answer", "a", "agent", "model", "response"))
_WORDS = "|".join(w for words in (*SPEAKERS, *LABELS) for w in words)
#: The forms a marker may have at the very start of a line, and one blank after it.
MARKER = (
    rf"(?i)^(?:(?:{_WORDS}):|#{{1,6}} ?(?:{_WORDS})(?::|(?=[ \t\r]*$))|\[(?:{_WORDS})\]:?"
    rf"|<\|?(?:{_WORDS})\|?>:?|\*\*(?:{_WORDS})(?::\*\*|\*\*:?)) ?"
)
#: Levels of the observed features: marker, length, number of the line in its message, question mark at the end.
LEVELS = (len(ROLES) + 1, 8, 4, 2)
#: Weight of the given beliefs, in messages.
PRIOR = 1.0
TURNS, LIMIT = 16, 2000
SEGMENT = ("__k", "__c", "__t", "__p")
#: Lines of segments that are worked on side by side.
TOGETHER = 20_000


@dataclass
class Hmm:
    """Log probabilities: first role, role after role, and features given the role.

    ``after`` leads to the first line of a message, ``within`` to another line
    without a marker, ``turned`` to another line with one.
    """

    first: np.ndarray
    after: np.ndarray
    shown: list[np.ndarray]
    within: np.ndarray | None = None
    turned: np.ndarray | None = None

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """Lines by roles."""
        out, rest = np.zeros((len(codes), len(ROLES))), codes.copy()
        for table, n in zip(self.shown, LEVELS, strict=True):
            out += table[:, rest % n].T
            rest //= n
        return out

    def steps(self) -> np.ndarray:
        """The three ways to come to a line, as numbered by :func:`ways`."""
        return np.stack([self.after if m is None else m for m in (self.after, self.within, self.turned)])


def ways(codes: np.ndarray) -> np.ndarray:
    """Per line: 0 for the first of a message, else 1, or 2 with a marker."""
    number = codes // (LEVELS[0] * LEVELS[1]) % LEVELS[2]
    return np.where(number == 0, 0, np.where(codes % LEVELS[0] > 0, 2, 1))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _any_marker(text: Column) -> Column:
    """Whether any line looks like a marked one; texts without are spared the search line by line."""
    return F.coalesce(text, F.lit("")).rlike("(?m)" + MARKER)


def _words(line: Column) -> Column:
    """1 to 3 if the line starts with a speaker's word, 4 to 6 with a label's, by role; else 0."""
    word = F.lower(F.regexp_replace(F.regexp_extract(line, MARKER, 0), "[^A-Za-z]", ""))
    out = F.lit(0)
    for k, words in enumerate((*SPEAKERS, *LABELS)):
        out = F.when(word.isin(*words), k + 1).otherwise(out)
    return out


def _markers(words: Column) -> Column:
    """Per line the role that its marker names, or 0: what the message gives evidence for.

    A speaker's word counts on the first line, and on others where the message names at
    least two speakers. A label's word counts only in an exchange: the message's marked
    lines begin with a user and no two that follow each other name the same role.
    """
    roles = F.transform(F.filter(words, lambda w: w > 0), lambda w: (w - 1) % 3 + 1)
    speakers = F.size(F.array_distinct(F.filter(words, lambda w: (w > 0) & (w < 4)))) > 1

    def exchange(found: Column) -> Column:
        twice = F.zip_with(found, F.slice(found, 2, F.greatest(F.size(found) - 1, F.lit(0))), lambda x, y: F.coalesce(x == y, F.lit(False)))
        return (F.size(found) > 1) & (F.get(found, F.lit(0)) == 2) & ~F.exists(twice, lambda x: x)

    known = F.transform(F.array(roles), lambda found: F.struct(exchange(found).alias("exchange"), speakers.alias("speakers")))

    def marker(word: Column, i: Column) -> Column:
        told = (F.get(known, F.lit(0))["exchange"]) | ((word < 4) & ((i == 0) | F.get(known, F.lit(0))["speakers"]))
        return F.when((word > 0) & told, (word - 1) % 3 + 1).otherwise(F.lit(0))

    return F.when(F.exists(words, lambda w: w > 0), F.transform(words, marker)).otherwise(words)


def observed(text: Column) -> Column:
    """The features of each line of a message as a number below the product of ``LEVELS``."""
    lines = split_lines(text)
    words = F.when(_any_marker(text), F.transform(lines, _words))
    markers = F.transform(F.array(words), _markers)[0]

    def code(line, marker, i):
        length = F.least(F.floor(F.log2(F.length(line) / 16 + 1)).cast("int"), F.lit(LEVELS[1] - 1))
        asks = F.rtrim(line).endswith("?").cast("int")
        return marker + LEVELS[0] * (length + LEVELS[1] * (F.least(i, F.lit(LEVELS[2] - 1)) + LEVELS[2] * asks))

    plain = F.transform(lines, lambda line, i: code(line, F.lit(0), i))
    both = F.arrays_zip(lines.alias("line"), markers.alias("marker"))
    return F.when(_any_marker(text), F.transform(both, lambda x, i: code(x["line"], x["marker"], i))).otherwise(plain)


def messages(df: DataFrame, conv_col: str, turn_col: str, text_col: str, role_col: str | None) -> DataFrame:
    """Rows with their segment: conversation, block of turns, and finer parts of crowded blocks."""
    last = F.lit((1 << 63) - 1)
    turn = F.coalesce(F.col(turn_col).cast("bigint"), last)
    rows = df.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(text_col).alias("text"),
        (F.col(role_col).cast("string") if role_col else F.lit(None).cast("string")).alias("role"),
        F.coalesce(F.concat(F.lit("c"), F.col(conv_col).cast("string")), F.lit("n")).alias("__k"),
        F.floor(turn / TURNS).cast("bigint").alias("__c"), turn.alias("__turn"), F.xxhash64(F.col(text_col)).alias("__h"), observed(F.col(text_col)).alias("__o"),
    )
    crowded = settled(rows.groupBy("__k", "__c", "__turn").agg(F.count("*").alias("n")).groupBy("__k", "__c").agg(F.sum("n").alias("all"), F.max("n").alias("most")).where(F.col("all") > LIMIT))
    if crowded.isEmpty():
        return rows.withColumn("__t", F.lit(0).cast("bigint")).withColumn("__p", F.lit(0).cast("bigint"))
    bits = F.greatest(F.ceil(F.log2(F.col("most") / LIMIT)), F.lit(0)).cast("int")
    parts = crowded.select("__k", "__c", bits.alias("bits"))
    # Parts of one turn follow the order of the hash: its leading bits, read as a number without sign.
    unsigned = F.shiftrightunsigned(F.col("__h").bitwiseXOR(F.lit(-(1 << 63))), 40)
    part = F.floor(unsigned / F.pow(F.lit(2.0), 24 - F.col("bits"))).cast("bigint")
    return (
        rows.join(parts, ["__k", "__c"], "left")
        .withColumn("__t", F.when(F.col("bits").isNull(), 0).otherwise(F.col("__turn")).cast("bigint"))
        .withColumn("__p", F.when(F.coalesce("bits", F.lit(0)) == 0, 0).otherwise(part).cast("bigint"))
        .drop("bits")
    )


def _ordered(rows: DataFrame, *columns: str) -> DataFrame:
    order = ["__turn", "__h", *(c for c in ("text", "__r") if c in columns)]
    return rows.select(*SEGMENT, "__turn", "__h", *columns).repartition(*SEGMENT).sortWithinPartitions(*SEGMENT, *order)


def _runs(batches, n_key: int):
    """(key, record batches' rows of it) for runs of equal leading columns, across batches."""
    key, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*[batch.column(i).to_pylist() for i in range(n_key)], strict=True))
        lo = 0
        for hi in range(1, len(keys) + 1):
            if hi == len(keys) or keys[hi] != keys[lo]:
                if keys[lo] != key:
                    if parts:
                        yield key, pa.Table.from_batches(parts)
                    key, parts = keys[lo], []
                parts.append(batch.slice(lo, hi - lo))
                lo = hi
    if parts:
        yield key, pa.Table.from_batches(parts)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _emit(found, schema: pa.Schema):
    rows = []
    for row in found:
        rows.append(row)
        if len(rows) >= 5000:
            yield _batch(rows, schema)
            rows = []
    if rows:
        yield _batch(rows, schema)


def _side_by_side(sizes: np.ndarray):
    """(positions of the segments that have a line i, number of their line i) for each i; longest segments first."""
    order = np.argsort(-sizes, kind="stable")
    begins, sorted_sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
    return order, [begins[: np.searchsorted(-sorted_sizes, -i, side="left")] + i for i in range(int(sorted_sizes[0]) if len(sizes) else 0)]


def all_best_paths(own: Hmm, seen: np.ndarray, way: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per segment of consecutive lines the best score from each first to each last role."""
    order, at = _side_by_side(sizes)
    n, steps = len(ROLES), own.steps()
    total = np.full((len(sizes), n, n), -np.inf)
    total[:, range(n), range(n)] = seen[at[0]]
    for rows in at[1:]:
        m = len(rows)
        total[:m] = (total[:m, :, :, None] + steps[way[rows]][:, None, :, :]).max(axis=2) + seen[rows][:, None, :]
    out = np.empty_like(total)
    out[order] = total
    return out


def all_fixed_paths(own: Hmm, seen: np.ndarray, way: np.ndarray, sizes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Best role of every line of segments whose first and last roles are given."""
    order, at = _side_by_side(sizes)
    steps, score, back = own.steps(), np.full((len(sizes), len(ROLES)), -np.inf), []
    every = np.arange(len(sizes))
    score[every, first[order]] = seen[at[0], first[order]]
    for rows in at[1:]:
        m = len(rows)
        step = score[:m, :, None] + steps[way[rows]]
        back.append(step.argmax(axis=1))
        score[:m] = step.max(axis=1) + seen[rows]
    role, path = last[order].copy(), np.empty(len(seen), dtype=np.int64)
    for rows, b in zip(reversed(at[1:]), reversed(back), strict=True):
        m = len(rows)
        path[rows] = role[:m]
        role[:m] = b[every[:m], role[:m]]
    path[at[0]] = role
    return path


def best_paths(own: Hmm, seen: np.ndarray, way: np.ndarray | None = None) -> np.ndarray:
    """Best score from each first to each last role of consecutive lines."""
    return all_best_paths(own, seen, np.zeros(len(seen), dtype=np.int64) if way is None else way, np.array([len(seen)]))[0]


def fixed_path(own: Hmm, seen: np.ndarray, first: int, last: int, way: np.ndarray | None = None) -> list[int]:
    """Best roles of consecutive lines whose first and last roles are given."""
    way = np.zeros(len(seen), dtype=np.int64) if way is None else way
    return all_fixed_paths(own, seen, way, np.array([len(seen)]), np.array([first]), np.array([last])).tolist()


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(codes of all lines, number of lines of each message)."""
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _groups(batches):
    """Lists of (segment, its rows), of about ``TOGETHER`` lines."""
    group, n = [], 0
    for key, table in _runs(batches, len(SEGMENT)):
        group.append((key, table))
        n += len(table.column("__o").combine_chunks().flatten())
        if n >= TOGETHER:
            yield group
            group, n = [], 0
    if group:
        yield group


def chunk_ends(own: Hmm, matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(first, last) role of every chunk on the best path through all of them."""
    score, back = own.first[:, None] + matrices[0], []
    starts = [score.argmax(axis=0)]
    reach = score.max(axis=0)
    for m in matrices[1:]:
        enter = reach[:, None] + own.after
        came, best = enter.argmax(axis=0), enter.max(axis=0)
        score = best[:, None] + m
        starts.append(score.argmax(axis=0))
        back.append(came)
        reach = score.max(axis=0)
    last = int(reach.argmax())
    out = []
    for i in range(len(matrices) - 1, -1, -1):
        first = int(starts[i][last])
        out.append((first, last))
        if i:
            last = int(back[i - 1][first])
    return out[::-1]


def estimate(rows: DataFrame, usable: Column | None = None) -> Hmm:
    """Count first roles, successions inside and between segments, and features per role, over all usable rows."""
    n, size = len(ROLES), math.prod(LEVELS)
    index = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col("role")).cast("int") - 1
    known = rows.withColumn("__r", F.when(index >= 0, index)).where("__r IS NOT NULL")
    known = known.where(usable) if usable is not None else known
    schema = pa.schema([("__k", pa.string()), ("__c", pa.int64()), ("__t", pa.int64()), ("__p", pa.int64()), ("kind", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])

    def told(table):
        codes, sizes = _codes(table.column("__o"))
        marker, way = codes % LEVELS[0], ways(codes)
        # The nearest line at or above that says who speaks: a marked one or the first of a message.
        says = np.maximum.accumulate(np.where((marker > 0) | (way == 0), np.arange(len(codes)), 0))
        roles = np.where(marker > 0, marker - 1, np.repeat(table.column("__r").to_numpy(), sizes))[says]
        return codes, way, roles

    def successions(batches):
        pairs, features = np.zeros((3, n, n), dtype=np.int64), np.zeros((n, size), dtype=np.int64)

        def each():
            for key, table in _runs(batches, len(SEGMENT)):
                codes, way, roles = told(table)
                np.add.at(features, (roles, codes), 1)
                np.add.at(pairs, (way[1:], roles[:-1], roles[1:]), 1)
                yield (*key, -1, int(roles[0]), int(roles[-1]), 1)
            for kind, table in enumerate((*pairs, features)):
                for a, b in zip(*np.nonzero(table), strict=True):
                    yield (None, None, None, None, kind, int(a), int(b), int(table[a, b]))

        yield from _emit(each(), schema)

    counted = settled(_ordered(known, "__r", "__o").mapInArrow(successions, "__k string, __c bigint, __t bigint, __p bigint, kind int, a int, b int, n bigint"))
    sums = counted.where("kind >= 0").groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect()
    # Between segments: the last role of one, the first of the next, none before a conversation's first.
    ends = counted.where("kind < 0").withColumn("before", F.lag("b").over(Window.partitionBy("__k").orderBy("__c", "__t", "__p")))
    sums += ends.groupBy(F.lit(0).alias("kind"), F.coalesce("before", F.lit(-1)).alias("a"), F.col("a").alias("b")).agg(F.count("*").alias("n")).collect()
    first, after = np.full(n, PRIOR), np.full((n, n), PRIOR / 10)
    # Beliefs: users and assistants take turns, a system message comes first.
    first += (PRIOR, 2 * PRIOR, 0)
    after[0, 1] += PRIOR
    after[1, 2] += PRIOR
    after[2, 1] += PRIOR
    # A speaker goes on inside a message, unless a marker says otherwise.
    within, turned = np.full((n, n), PRIOR / 10) + 10 * PRIOR * np.eye(n), after.copy()
    for r in sums:
        if r["a"] < 0:
            first[r["b"]] += r["n"]
        elif r["kind"] < 3:
            (after, within, turned)[r["kind"]][r["a"], r["b"]] += r["n"]
    shown = [np.full((n, k), PRIOR / k) for k in LEVELS]
    for role in range(n):
        shown[0][role, 0] += PRIOR
        shown[0][role, role + 1] += 20 * PRIOR
    for r in sums:
        code = r["b"]
        for table, k in zip(shown, LEVELS, strict=True) if r["kind"] == 3 else ():
            table[r["a"], code % k] += r["n"]
            code //= k
    shares = [np.log(t / t.sum(axis=1, keepdims=True)) for t in (after, within, turned, *shown)]
    return Hmm(np.log(first / first.sum()), shares[0], shares[3:], *shares[1:3])


def chat_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", role_col: str | None = "role", usable: Column | None = None) -> DataFrame:
    """Per message and speaker in it: conversation, turn, recovered ``role``, its ``rendered`` part and its first ``line``.

    ``role_col``, if given, is only counted for the estimates, for rows that are
    ``usable``. A turn opens with ``<|im_start|>role`` and ends with ``<|im_end|>``;
    lines of one role that follow each other share a turn, also across messages; a
    message of one speaker gives one row. Markers are taken off, and the two strings inside a text are broken up, so turns can't be forged.
    """
    rows = settled(messages(df, conv_col, turn_col, text_col, role_col))
    own = estimate(rows, usable)
    keys = pa.schema([("__k", pa.string()), ("__c", pa.int64()), ("__t", pa.int64()), ("__p", pa.int64())])

    def summed(batches):
        schema = pa.schema([*keys, ("m", pa.list_(pa.float64()))])

        def each():
            for group in _groups(batches):
                lines = [_codes(table.column("__o"))[0] for _, table in group]
                codes = np.concatenate(lines)
                for (key, _), m in zip(group, all_best_paths(own, own.emissions(codes), ways(codes), np.array([len(x) for x in lines])), strict=True):
                    yield (*key, m.ravel())

        yield from _emit(each(), schema)

    matrices = _ordered(rows, "__o").mapInArrow(summed, "__k string, __c bigint, __t bigint, __p bigint, m array<double>")

    def decided(batches):
        schema = pa.schema([*keys, *((x, pa.int32()) for x in ("first", "last", "before", "then"))])

        def each():
            for _, table in _runs(batches, 1):
                segments = list(zip(*[table.column(c).to_pylist() for c in SEGMENT], strict=True))
                ends = chunk_ends(own, [np.array(m).reshape(len(ROLES), len(ROLES)) for m in table.column("m").to_pylist()])
                for i, (segment, (first, last)) in enumerate(zip(segments, ends, strict=True)):
                    yield (*segment, first, last, ends[i - 1][1] if i else -1, ends[i + 1][0] if i + 1 < len(ends) else -1)

        yield from _emit(each(), schema)

    paths = matrices.repartition("__k").sortWithinPartitions(*SEGMENT).mapInArrow(decided, "__k string, __c bigint, __t bigint, __p bigint, first int, last int, before int, then int")
    joined = rows.join(paths, list(SEGMENT))
    conv_kind, turn_kind = (df.schema[c].dataType.simpleString() for c in (conv_col, turn_col))

    def rendered(batches):
        for group in _groups(batches):
            lines = [_codes(table.column("__o")) for _, table in group]
            codes, sizes = np.concatenate([x for x, _ in lines]), np.array([len(x) for x, _ in lines])
            ends = {c: np.array([table.column(c)[0].as_py() for _, table in group]) for c in ("first", "last", "before", "then")}
            path = all_fixed_paths(own, own.emissions(codes), ways(codes), sizes, ends["first"], ends["last"])
            begins = np.cumsum(sizes) - sizes
            for k, (_, table) in enumerate(group):
                own_path, own_codes = path[begins[k] : begins[k] + sizes[k]].tolist(), lines[k][0]
                around, i = [int(ends["before"][k]), *own_path, int(ends["then"][k])], 0
                rows, taken = [], []
                for row, (said, cuts) in enumerate(zip(table.column("said").to_pylist(), table.column("cuts").to_pylist(), strict=True)):
                    start = 0
                    for at in range(len(said)):
                        # around[j + 1] is the role of line j.
                        if at + 1 < len(said) and around[i + at + 2] == around[i + at + 1]:
                            continue
                        role = around[i + at + 1]
                        opens, closes = around[i + start] != role, role != around[i + at + 2]
                        # Only the marker that opens the part goes; all else stays as it is.
                        marked = own_codes[i + start] % LEVELS[0] == role + 1
                        text = "\n".join(said[start : at + 1])[cuts[start] if marked else 0 :]
                        text = text.replace("<|im_start|>", "<| im_start |>").replace("<|im_end|>", "<| im_end |>")
                        rows.append((ROLES[role], (f"<|im_start|>{ROLES[role]}\n" if opens else "") + text + ("<|im_end|>\n" if closes else "\n"), start))
                        taken.append(row)
                        start = at + 1
                    i += len(said)
                told = table.select(["conv", "turn"]).take(pa.array(taken))
                done = told.append_column("role", [pa.array([r[0] for r in rows])]).append_column("rendered", [pa.array([r[1] for r in rows])]).append_column("line", [pa.array([r[2] for r in rows], pa.int32())])
                yield from done.combine_chunks().to_batches()

    said = split_lines(F.col("text"))
    none = F.transform(said, lambda x: F.lit(0))
    cuts = F.when(_any_marker(F.col("text")), F.transform(said, lambda x: F.length(F.regexp_extract(x, MARKER, 0)))).otherwise(none)
    told = _ordered(joined.withColumn("said", said).withColumn("cuts", cuts), "__o", "text", "conv", "turn", "said", "cuts", "first", "last", "before", "then")
    out = told.mapInArrow(rendered, f"conv {conv_kind}, turn {turn_kind}, role string, rendered string, line int")
    return out.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), "role", "rendered", "line")
