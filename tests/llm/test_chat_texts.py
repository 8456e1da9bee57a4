"""What people wrote stays: lists, tables, code, indents; and chunked Viterbi with all three steps."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contractcheck.llm import chat

TALK = "conv_id bigint, turn bigint, role string, text string"


def parts(spark, rows):
    out = chat.chat_turns(spark.createDataFrame(rows, TALK)).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r["conv_id"], r["turn"], r["line"])):
        found.setdefault((r["conv_id"], r["turn"]), []).append((r["line"], r["role"], r["rendered"]))
    return found


def content(role, rendered):
    text = rendered.removeprefix(f"<|im_start|>{role}\n")
    return text.removesuffix("\n").removesuffix("<|im_end|>")


KEPT = [
    ("user", "Which is right?\nA: Paris\nB: London"),
    ("assistant", "Here it is:\na | b | c\n1 | 2 | 3\nModel: X200\nAnswer: 42"),
    ("user", "    indented code\n\tmore\n  "),
    ("assistant", "A: first option\nB: second option\nC: third"),
    ("user", "Config:\nUser: admin\nPassword: x"),
    ("assistant", "# Model\ntext\n# Answer\ntext"),
    ("user", "me | you\n--- | ---\nq | a"),
    ("assistant", "\n\n  outer blanks  \n"),
]


def test_labels_lists_and_tables_stay_one_part(spark):
    rows = [(c, t, role, text) for c in range(12) for t, (role, text) in enumerate(KEPT)]
    found = parts(spark, rows)
    for t, (role, text) in enumerate(KEPT):
        for c in range(12):
            (line, got, rendered), = found[c, t]
            assert (line, got, content(got, rendered)) == (0, role, text)


def test_exchanges_are_split(spark):
    texts = {
        "Q: what is it?\nA: a thing\nQ: sure?\nA: yes": [(0, "user", "what is it?"), (1, "assistant", "a thing"), (2, "user", "sure?"), (3, "assistant", "yes")],
        "### User\nhi\n### Assistant\n  hello": [(0, "user", "\nhi"), (2, "assistant", "\n  hello")],
        "<|user|>hi\n<|assistant|> there": [(0, "user", "hi"), (1, "assistant", "there")],
        "**Human:** one\n**AI:** two\nthree": [(0, "user", "one"), (1, "assistant", "two\nthree")],
        "[System] rules\n[User] ask": [(0, "system", "rules"), (1, "user", "ask")],
        "Question: why?\nAnswer: because\nA: not this": None,
    }
    plain = [(c, t, ("user", "assistant")[t % 2], f"plain words {c}?\nand more\nand {t}") for c in range(100, 140) for t in range(4)]
    found = parts(spark, plain + [(i, 0, None, text) for i, text in enumerate(texts)])
    for i, (text, wanted) in enumerate(texts.items()):
        got = [(line, role, content(role, r)) for line, role, r in found[i, 0]]
        assert got == wanted if wanted else [g[2] for g in got] == [text]


LINES = ["User: hi", "user:", "Assistant:  two", "### System", "A: x", "Q: y?", "  indented", "", "a | b", "[Bot] z", "**Human** q", "Answer: 4", "plain", "<|user|>u", "\ttab ", "é: ö"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(LINES), min_size=1, max_size=7).map("\n".join), min_size=5, max_size=30))
def test_contents_and_removed_markers_make_the_text(spark, texts):
    import re

    rows = [(i % 4, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(texts)]
    found = parts(spark, rows)
    for i, text in enumerate(texts):
        lines, got = text.split("\n"), found[i % 4, i]
        assert got[0][0] == 0
        ends = [g[0] for g in got[1:]] + [len(lines)]
        for (start, role, rendered), end in zip(got, ends, strict=True):
            whole, said = "\n".join(lines[start:end]), content(role, rendered)
            taken = whole.removesuffix(said) if said else whole
            assert taken + said == whole
            assert taken == "" or re.fullmatch(chat.MARKER.replace("(?=[ \\t\\r]*$)", ""), taken) or re.match(chat.MARKER, whole.split("\n")[0])[0] == taken


@pytest.mark.parametrize("seed", range(4))
def test_chunked_viterbi_with_all_steps(seed):
    """All paths tried on short runs, one long pass on long ones; first lines, plain lines and marked lines mixed."""
    rng = np.random.default_rng(seed)
    n = len(chat.ROLES)
    draw = lambda *shape: np.log(rng.dirichlet(np.ones(n), *shape))
    own = chat.Hmm(draw(), draw(n), [np.log(rng.dirichlet(np.ones(k), n)) for k in chat.LEVELS], draw(n), draw(n))

    def chunked(seen, way, cuts):
        pieces = [(seen[a:b], way[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        ends = chat.chunk_ends(own, [chat.best_paths(own, s, w) for s, w in pieces])
        return [r for (s, w), (a, b) in zip(pieces, ends, strict=True) for r in chat.fixed_path(own, s, a, b, w)]

    def score(path, seen, way):
        steps = own.steps()
        return own.first[path[0]] + sum(seen[i, r] for i, r in enumerate(path)) + sum(steps[way[i], path[i - 1], path[i]] for i in range(1, len(path)))

    import itertools

    for size, cuts in ((6, [0, 2, 6]), (200, [0, 1, 17, 90, 200])):
        codes = rng.integers(0, np.prod(chat.LEVELS), size)
        number = np.arange(size) % 5 * 0
        starts = set(cuts) | set(rng.integers(0, size, size // 4).tolist())
        for i in range(size):
            number[i] = 0 if i in starts else min(number[i - 1] + 1, chat.LEVELS[2] - 1)
        base = chat.LEVELS[0] * chat.LEVELS[1]
        codes = codes % base + base * number + base * chat.LEVELS[2] * (codes // (base * chat.LEVELS[2]))
        seen, way = own.emissions(codes), chat.ways(codes)
        assert size < 10 or set(way.tolist()) == {0, 1, 2}
        got = chunked(seen, way, cuts)
        if size < 10:
            best = max(itertools.product(range(n), repeat=size), key=lambda p: score(p, seen, way))
            assert np.isclose(score(got, seen, way), score(best, seen, way))
        else:
            assert np.isclose(score(got, seen, way), score(chunked(seen, way, [0, size]), seen, way))
            reach, steps = own.first + seen[0], own.steps()
            for i in range(1, size):
                reach = (reach[:, None] + steps[way[i]]).max(axis=0) + seen[i]
            assert np.isclose(score(got, seen, way), reach.max())
