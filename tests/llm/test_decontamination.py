import random

import pyarrow as pa
import pytest

from filedrop.llm.decontamination import Shard, Item, find_leaks, item_shards, question_and_answer, remove_leaks


def test_wand_retrieves_all_above_the_threshold():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [Item(i, " ".join(rng.choices(vocabulary, k=rng.randint(5, 15))), "end") for i in range(150)]
    shard = Shard(items)
    for index in shard.indexes:
        for _ in range(60):
            passage = [w.encode() for w in rng.choices(vocabulary, k=40)]
            import numpy as np

            ids = shard.terms(passage, np.array([0, len(passage)]))
            terms = [t for t in np.unique(ids[:-1]).tolist() if t < len(shard.keys)]
            for threshold in (0.05, 0.2, 0.5):
                brute = {}
                for d in range(len(index.items)):
                    score = sum(x for t in terms for e, x in index.postings.get(t, []) if e == d)
                    if score >= threshold - 1e-9:
                        brute[d] = score
                got = dict(index.retrieve(terms, threshold))
                assert got.keys() == brute.keys() and all(got[d] == pytest.approx(brute[d]) for d in got)


def test_items_score_one_against_themselves():
    texts = ["One two three. Four five six.", "Alone", "a b", "x " * 70]
    shard = Shard([Item(i, *question_and_answer(t)) for i, t in enumerate(texts)])
    found = shard.matches(pa.array(texts + [None, ""]), 0.5, 0.5)
    assert [(t, i) for t, i, *_ in found] == [(0, 0), (2, 2), (3, 3)]
    assert all(score == pytest.approx(1) for _, _, score, *_ in found)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_planted_items_are_found_and_clean_texts_left(spark, docs, rows):
    rng = random.Random(8)
    noise = lambda n: " ".join(f"n{rng.randint(0, 400)}" for _ in range(n))
    items = [(i, f"{noise(rng.randint(8, 30))}. {noise(rng.randint(4, 12))}.") for i in range(60)] + [(99, None), (98, "")]
    planted = [(1000 + i, f"{noise(rng.randint(0, 300))} {t.upper() if i % 2 else t} {noise(rng.randint(0, 300))}")
               for i, t in items[:60]]
    question_only = (3000, noise(50) + " " + items[0][1].split(".")[0] + " " + noise(40))
    clean = [(i, noise(300)) for i in range(100)] + [(500, None), (501, ""), question_only, (502, noise(60_000))]
    long = (2000, noise(50_000) + " " + items[5][1] + " " + noise(50_000))
    df = docs(planted + clean + [long, planted[0], (None, items[3][1])], "score")
    bench = items_of(spark, items + [items[0]])
    want = [(1000 + i, i) for i in range(60)] + [(2000, 5), (None, 3), (1000, 0), (1000, 0), (1000, 0)]
    found = find_leaks(df, bench)
    assert rows(found, "doc_id", "item_id") == sorted(want, key=lambda r: (r[0] is None, r))
    kept = remove_leaks(df, bench)
    assert kept.columns == df.columns and rows(kept, "doc_id") == sorted((d,) for d, _ in clean)
    # Many shards find the same.
    assert len(list(item_shards(bench, 4000))) > 1


def test_empty_tables(spark, docs):
    assert find_leaks(docs([]), items_of(spark, [(1, "a b c d")])).count() == 0
    assert find_leaks(docs([(1, "a b")]), items_of(spark, [])).count() == 0
    assert remove_leaks(docs([(1, "a b")]), items_of(spark, [])).count() == 1


def test_question_and_answer():
    assert question_and_answer("What is it? A fox.") == ("What is it?", " A fox.")
    assert question_and_answer("a b c d e f") == ("a b c d", "e f") and question_and_answer("") == ("", "")


def test_letters_are_compared_in_one_form(spark, docs, rows):
    greek = "Ο ΣΟΦΟΣ ΑΝΘΡΩΠΟΣ ΛΕΓΕΙ ΤΟΥΣ ΛΟΓΟΥΣ ΤΟΥ ΣΩΚΡΑΤΗ ΣΗΜΕΡΑ"
    turkish = "İSTANBUL VE İZMİR İKİ BÜYÜK ŞEHİR OLARAK BİLİNİR BUGÜN"
    plain = "ο σοφος ανθρωπος λεγει τους λογους του σωκρατη σημερα"
    items = items_of(spark, [(1, greek), (2, turkish)])
    got = find_leaks(docs([(1, greek), (2, turkish), (3, f"x y {greek.lower()} z"), (4, plain), (5, "a b c d e f")]), items)
    assert rows(got, "doc_id", "item_id") == [(1, 1), (2, 2), (3, 1), (4, 1)]


def test_scores_do_not_depend_on_shards(spark, docs, rows, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.randint(6, 40))) for _ in range(200)]
    items = items_of(spark, list(enumerate(texts)) + [(900, "one")])
    df = docs([(i, f"{t} {texts[-i]}") for i, t in enumerate(texts[:60])])
    once = rows(find_leaks(df, items, 0.4))
    monkeypatch.setattr("filedrop.llm.decontamination.item_shards.__defaults__", (4000,))
    assert len(list(item_shards(items))) >= 6
    many = rows(find_leaks(df, items, 0.4))
    assert [r[:2] for r in many] == [r[:2] for r in once] and len(once) > 60
    assert [x for r in many for x in r[2:]] == pytest.approx([x for r in once for x in r[2:]])
