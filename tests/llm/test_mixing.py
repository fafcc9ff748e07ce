import re
from fractions import Fraction

import pytest

from filedrop.llm.mixing import apportion, mix, taken_texts, targets


def highest_quotients(weights, seats):
    """One seat after the other, to the highest quotient; the first unit wins a tie."""
    got = [0] * len(weights)
    for _ in range(seats):
        best = max(range(len(weights)), key=lambda i: (Fraction(weights[i], 2 * got[i] + 1), -i))
        got[best] += 1
    return got


@pytest.mark.parametrize("weights, seats", [
    ([53, 24, 23], 7), ([1, 1, 1, 1], 2), ([0, 5, 0], 3), ([100, 1, 1, 1, 1, 1, 1, 1], 9), ([7] * 11, 30), ([3, 6, 9], 0),
    ([1000, 10, 10, 10, 10, 10, 10, 10, 10, 10], 5),
])
def test_seats_go_to_the_highest_quotients(spark, weights, seats):
    units = [("g", i, w, seats) for i, w in enumerate(weights)] + [(None, i, w, seats) for i, w in enumerate(weights)]
    df = apportion(spark.createDataFrame(units, "g string, i int, w bigint, s bigint"), ["g"], "w", "s", ["i"], "n")
    for group in ("g", None):
        got = [r["n"] for r in sorted(df.collect(), key=lambda r: r["i"]) if r["g"] == group]
        assert got == highest_quotients(weights, seats)


def stepwise(sizes, share=1.5, most=2):
    """Resharing what is above the limit until none is."""
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    left, open_, target = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if weights[i] * level > most * sizes[i]}
        if not full:
            for i in open_:
                target[i] = weights[i] * level
            return target
        for i in full:
            target[i] = most * sizes[i]
            left -= target[i]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 100, 5], [0, 0], [7], [0, 50, 3, 3, 900], [5, 4, 3, 2, 1, 0]])
def test_targets_stop_at_the_limit(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size bigint")
    got = [r["target"] for r in sorted(targets(df).collect(), key=lambda r: r["source"])]
    assert got == pytest.approx(stepwise(sizes))


def test_mix_of_nulls_repeats_and_clashing_columns(spark, rows):
    word = lambda n: "w " * n
    data = [(i, word(40 + i % 7), ["a", "b", None][i % 3], "x") for i in range(300)]
    data += [(None, word(9), "b", "x"), (7, word(47), "b", "x"), (7, word(47), "b", "x"), (900, None, "a", "x"),
             (901, "", "z", "x"), (902, word(60_000), "é", "x"), (None, "a b\x0bc", "é", "x")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string, taken string")
    keep = ("doc_id", "source", "taken")
    out = mix(df, keep=keep)
    assert out.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    got = rows(out)
    assert got == rows(mix(df.repartition(5), keep=keep))  # reruns agree
    assert len(got) == len(data)
    sizes = {}
    for _, text, source, _ in data:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = dict(zip(order, stepwise([sizes[s] for s in order])))
    for source in order:
        mine = [r for r in got if r[1] == source]
        assert sum(r[2] for r in mine) == sizes[source] and all(r[3] == sizes[source] for r in mine)
        assert mine[0][4] == pytest.approx(want[source])
        assert sum(r[5] for r in mine) == pytest.approx(want[source], abs=16)
    assert all(0 <= r[5] <= 2 * r[2] for r in got)


def test_taken_texts_are_the_mix(spark):
    # Source a is taken more than once, b in part; words tell their document and place.
    sizes = {"a": 40, "b": 200}
    data = [(i, "\n".join(f"{i}.{k}" for k in range(sizes[s])) + " ", s, "x") for s in sizes for i in range(*{"a": (0, 60), "b": (100, 160)}[s])]
    data += [(None, None, "b", "x"), (900, " ", "a", "x")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string, passes string")
    mixed = mix(df, keep=tuple(df.columns), spans=True)
    plain = {r["doc_id"]: r for r in mix(df).collect()}
    for r in mixed.collect():
        spans = [(s["start"], s["end"]) for s in r["spans"]]
        assert r["passes"] * r["size"] + sum(b - a for a, b in spans) == r["taken"] == plain[r["doc_id"]]["taken"]
        assert all(0 <= a < b <= r["size"] for a, b in spans) and spans == sorted(spans)
    spans = {r["doc_id"]: [k for s in r["spans"] for k in range(s["start"], s["end"])] for r in mixed.collect()}
    written, per_source = {}, {"a": 0, "b": 0}
    for r in taken_texts(mixed).collect():
        assert len(r["text"].split()) == r["taken"] > 0
        per_source[r["source"]] += r["taken"]
        written.setdefault(r["doc_id"], []).extend(r["text"].split())
        if r["text"] != dict((d[0], d[1]) for d in data)[r["doc_id"]]:
            assert r["text"].split() == [f"{r['doc_id']}.{k}" for k in spans[r["doc_id"]]] and r["text"] == r["text"].strip()
    assert {d: len(w) for d, w in written.items()} == {d: r["taken"] for d, r in plain.items() if r["taken"]}
    for source, target in {(r["source"], r["target"]) for r in mixed.collect()}:
        assert per_source[source] == pytest.approx(target, abs=16)


def test_empty_table(spark):
    assert mix(spark.createDataFrame([], "doc_id bigint, text string, source string")).count() == 0
