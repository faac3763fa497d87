"""Template leaks against a plain search, re-parameterised items and edge rows."""

import re

from thalimart.llm import decontaminate as D

BENCH = "item_id long, text string, slots string"
DOCS = "doc_id long, text string, item_id string, key string"
ITEM = ("A farmer called Anna sells 12 kg of apples for 30 dollars and then buys 12 kg of pears "
        "from Peter, so how much money does Anna have left after 3 hours?")


def run(spark, docs, items):
    got = D.leaks(spark.createDataFrame([(d, t, "q", "k") for d, t in docs], DOCS),
                  spark.createDataFrame([(i, t, "s") for i, t in items], BENCH))
    return {(r.doc_id, r.item_id): (r.matched, r.verbatim, r.n_windows) for r in got.collect()}


def test_verbatim_and_reparameterised_items_are_found_and_others_left(spark):
    again = ITEM.replace("Anna", "Omar").replace("Peter", "Lena").replace("12 kg", "7 km").replace("30", "1,250").replace("3 hours", "45 minutes")
    mixed = ITEM.replace("12 kg of apples", "5 kg of apples").replace("Anna have", "Rosa have")  # one slot, two values
    filler = "completely other words follow here in this part of the text without any meaning at all"
    docs = [(1, f"{filler}. {ITEM} {filler}"), (2, f"{filler}. {again}"), (3, filler),
            (4, "Someone sells 12 kg of apples for 30 dollars to somebody else entirely."), (5, mixed), (None, ITEM),
            (6, None), (7, ""), (1, ITEM), (8, (filler + " ") * 5000 + ITEM)]
    got = run(spark, docs, [(10, ITEM), (11, ITEM), (12, None), (13, ""), (14, "5 7 9"), (15, "the quick brown fox jumps")])
    assert {k[0] for k in got} >= {1, 2, None, 8}
    assert {k[0] for k in got}.isdisjoint({3, 4, 6, 7})
    assert got[1, 10][0] == got[1, 10][1] == got[1, 10][2] and got[1, 10] == got[1, 11]
    assert got[2, 10][0] == got[2, 10][2] and got[2, 10][1] < got[2, 10][0]
    assert got.get((5, 10), (0,))[0] < got[1, 10][0]  # inconsistent slots cost windows


def test_short_items_need_every_token(spark):
    got = run(spark, [(1, "see the quick brown fox jumps over"), (2, "the quick brown cat jumps over"), (3, "5 7 9")],
              [(15, "the quick brown fox jumps"), (14, "5 7 9")])
    assert set(got) == {(1, 15)}


def test_empty_tables(spark):
    assert run(spark, [], [(1, ITEM)]) == {} and run(spark, [(1, ITEM)], []) == {}


def test_planted_passages_equal_a_plain_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()}

    def flat(t):
        return " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [(r.item_id, flat(r.text).split()) for r in bench.collect()]
    want = set()
    for r in docs.collect():
        text = flat(r.text)
        for i, words in items:
            if sum(" " + " ".join(words[k:k + 8]) + " " in text for k in range(len(words) - 7)) >= 6:
                want.add((r.doc_id, i))
    assert got == want and len(got) > 10


def test_rows_that_share_an_id_do_not_pool(spark):
    words = ITEM.split()
    parts = [" ".join(words[k:k + 10]) for k in (0, 8, 16)]  # each under ENOUGH windows
    got = run(spark, [*((None, f"{p} {i} and on") for i, p in enumerate(parts)), *((3, f"{p} {i} and on") for i, p in enumerate(parts))], [(10, ITEM)])
    assert got == {}
    other = ITEM.replace("Anna", "Omar").replace("12", "7")
    more = ITEM.replace("Anna", "Lena").replace("12", "9")
    got = D.leaks(spark.createDataFrame([(3, t, "q", "k") for t in (other, more, other, "nothing in here")], DOCS),
                  spark.createDataFrame([(10, ITEM, "s")], BENCH)).collect()
    assert sorted((r.doc_id, r.matched, r.n_windows) for r in got) == [(3, 25, 25)] * 2


def test_copies_with_values_of_their_own_do_not_out_vote_each_other(spark):
    def variant(k):
        name, other = [("Omar", "Lena"), ("Mia", "Paul"), ("Zoe", "Hugo"), ("Ivan", "Rosa"), ("Nina", "Emil")][k % 5]
        return (ITEM.replace("Anna", name).replace("Peter", other).replace("12 kg", f"{40 + k} km").replace("30", str(100 + 7 * k))
                .replace("3 hours", f"{61 + k} minutes"))
    docs = [(n, "\n".join(variant((n * 7 + k) % 23) for k in range(2 + n % 4))) for n in range(40)]
    docs += [(100 + n, "\n".join([ITEM, *(variant(n + k).replace(f"{40 + n + k} km", "55 km") for k in range(3))])) for n in range(10)]
    longer = variant(1).replace("apples", "very small apples")  # words put in move the offset
    docs += [(200, "\n".join([variant(0), longer, variant(2)]))]
    got = run(spark, docs, [(10, ITEM)])
    assert set(got) == {(d, 10) for d, _ in docs}
    assert all(v[0] == 25 for v in got.values())
    assert all(got[100 + n, 10][1] == 25 for n in range(10))


def test_items_of_numbers_names_and_unspaced_scripts_are_found_verbatim(spark):
    sums = "12 + 7 = 19, 19 + 5 = 24, 24 + 8 = 32, 32 - 11 = 21, 21 * 2 = 42"
    title = "The Merchant Of The Northern Harbour And The Seven Silver Bells Of King Aldric The Younger"
    table = "Anna 12 kg 7 km Peter 9 kg 4 km Omar 3 kg 8 km Lena 15 kg 6 km"
    han = "小明有十二个苹果他把其中五个送给了小红请问他现在还剩下多少个苹果"
    part = "Which of these is right if 3 5 8 13 and 21 34 55 or 60 70 are given in this order to the class"
    items = [(1, sums), (2, title), (3, table), (4, han), (5, "4 8 15 16 23"), (6, part)]
    filler = "other words follow here in this part of the text"
    docs = [(i, f"{filler} {t} {filler}") for i, t in items]
    docs[-1] = (6, f"{filler} right if 3 5 8 13 and 21 34 55 or 60 70 {filler}")  # thirteen words of it
    docs += [(11, "12 + 7 = 19, 20 + 5 = 25, 24 + 9 = 33, 32 - 12 = 20, 21 * 3 = 63"), (12, title.replace("Of ", "By ")),
             (13, table.replace("12", "13").replace("9", "10").replace("3 kg", "5 kg")), (14, "小明有十二个梨他把其中五个送给了小红"),
             (15, "4 8 15 17 23"), (16, "right if 3 5 8 13 and 22 34 55 or 60 70"), (17, "请看其中五个送给了小红请问他现在吗")]
    got = run(spark, docs, items)
    assert set(got) == {(i, i) for i, _ in items} | {(17, 4)}
    assert all(got[i, i][0] == got[i, i][1] == got[i, i][2] for i in range(1, 6))
    assert got[17, 4][0] == 7 and got[6, 6][0] == 6
