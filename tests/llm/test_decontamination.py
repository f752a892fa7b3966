import random

import numpy as np
import pyarrow as pa

from packwright.llm import decontamination

ITEM = "A train leaves Boston at 60 mph. After 3 hours Anna asks how far the train from Boston has gone, and Anna writes 60 times 3 down."


def found(spark, texts, items=((1, ITEM),), **options):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame(list(items), "item_id bigint, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontamination.leaks(df, bench, **options).collect()}


def test_finds_copies_and_other_numbers_and_names(spark):
    changed = ITEM.replace("60", "75").replace("Boston", "Denver").replace("Anna", "Maria")
    mixed = ITEM.replace("Boston", "Denver", 1).replace("Anna", "Maria", 1).replace("60", "75", 1).replace(" 3 ", " 4 ", 1)
    got = found(spark, [None, "", "Some words. " + ITEM + " More words.", "intro " * 30 + changed, mixed, "nothing of this kind " * 20, ITEM, ITEM])
    assert set(got) == {(2, 1), (3, 1), (6, 1), (7, 1)}
    assert got[6, 1]["verbatim"] and not got[3, 1]["verbatim"] and got[3, 1]["slot_consistency"] == 1.0 and got[3, 1]["n_slots"] >= 6


def test_coverage_and_short_items(spark):
    half = " ".join(ITEM.split()[:9])
    items = [(1, ITEM), (2, "four words are enough"), (3, "too short"), (4, None), (None, "a b c d e f")]
    got = found(spark, [half, "yes: four words are enough here", "too short", "a b c d e f"], items)
    assert set(got) == {(1, 2)}


def test_blocks_give_the_same_leaks(spark):
    items = [(i, f"item number {'abcdefgh'[i]} asks about {'klmnopqr'[i]} things in a row of words") for i in range(8)]
    texts = [t for _, t in items] + ["x " + items[3][1] + " y"]
    one = found(spark, texts, items)
    assert set(one) == set(found(spark, texts, items, items_per_block=2)) == {(i, i) for i in range(8)} | {(8, 3)}


def test_clean_keeps_columns_and_null_ids(spark):
    df = spark.createDataFrame([(1, ITEM, 5), (2, "fine text", 6), (None, "other text", 7), (None, ITEM, 8)], "doc_id bigint, text string, bad_id int")
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    kept = decontamination.clean(df, bench)
    assert kept.columns == df.columns and sorted(r["text"] for r in kept.collect()) == ["fine text"]
    assert decontamination.leaks(df.limit(0), bench).count() == 0 and decontamination.leaks(df, bench.limit(0)).count() == 0


def test_placeholders():
    t = decontamination.canonical(pa.array(["Run 5 km with Éva. The end, 3.5% of it", None]))
    assert t.slots.tolist() == [False, True, True, False, True, False, False, True, False, False]
    assert t.first.tolist() == [0, 10, 10]


def test_names_that_begin_sentences_or_have_more_words_and_short_items(spark):
    tom = "Tom has 5 red apples. Sara has 3 apples more. Tom gives Sara 2 apples today."
    ben = tom.replace("Tom", "Ben").replace("Sara", "Mia")
    york = ITEM.replace("Boston", "New York")
    short = "a farmer sells nine brown hens to his old neighbour"
    items = [(1, tom), (2, ITEM), (3, short)]
    texts = [ben, york, short.replace("brown", "white"), short.replace("brown", "very brown"), short.replace(" brown", ""), short.replace("brown hens", "white cows"),
             ben.replace("Ben gives", "Joe gives"), ITEM.replace("3 hours", "3 long hours").replace("Boston has", "Boston already has")]
    got = found(spark, texts, items)
    assert set(got) == {(0, 1), (1, 2), (2, 3), (3, 3), (4, 3), (7, 2)}
    assert got[0, 1]["coverage"] == got[1, 2]["coverage"] == 1.0 and got[0, 1]["slot_consistency"] == 1.0 and not got[0, 1]["verbatim"]
    assert got[2, 3]["matched_tokens"] == 9 and got[7, 2]["matched_tokens"] == 26


def test_placeholders_alone_are_no_leak(spark):
    items = [(1, "Paris 1900 London 1950"), (2, "What is 12 34 56 78 90 11 22 33 44 55"), (3, "12 34 56 78 90 11 22 33 44 55 66")]
    texts = ["Then Berlin 2001 Madrid 2004 came.", "table " + " ".join(map(str, range(1, 14))), "in Paris 1900 London 1950 again", "see 12 34 56 78 90 11 22 33 44 55 66"]
    assert set(found(spark, texts, items)) == {(2, 1), (3, 2), (3, 3)}


def test_number_words_and_capitals_of_other_scripts(spark):
    items = [(1, "After five days the baker sells three loaves to each guest"), (2, "Утром Анна даёт коту три рыбы и потом Анна пьёт чай")]
    texts = [items[0][1].replace("five", "seven").replace("three", "nine"), items[1][1].replace("Анна", "Ольга").replace("три", "пять"), items[1][1].replace("Анна", "Юля")]
    got = found(spark, texts, items)
    assert set(got) == {(0, 1), (1, 2), (2, 2)} and got[1, 2]["slot_consistency"] == 1.0
    capital, lowered = decontamination._capitals(np.frombuffer("aZÉÑΑΩЖЯя".encode(), np.uint8))
    assert bytes(lowered).decode() == "azéñαωжяя" and capital.sum() == 7


def test_tables_of_numbers_take_little(spark):
    draw = np.random.default_rng(1)
    items = [(i, " ".join(map(str, draw.integers(0, 10_000, 30)))) for i in range(2000)]
    table = " ".join(map(str, draw.integers(0, 10_000, 100_000)))
    got = found(spark, [table, f"{table} {items[7][1]} {table}"], items)
    assert set(got) == {(1, 7)} and got[1, 7]["verbatim"]


def test_against_a_plain_search(spark):
    """Items with other numbers and names, found where all windows of a plain template agree."""
    pick = random.Random(4)
    words = ["baker", "sells", "every", "loaf", "before", "noon", "and", "keeps", "coins", "inside", "wooden", "boxes", "near", "door"]
    items, texts, expected = [], [], set()
    for i in range(25):
        parts = pick.choices(words, k=14)
        parts[3], parts[9] = "{a}", "{n}"
        template = " ".join(parts)
        items.append((i, template.format(a="Anna", n=12)))
        texts.append(" ".join(pick.choices(words, k=30)) + " " + template.format(a=pick.choice(["Omar", "Lena"]), n=pick.randrange(100)) + " so")
    for d, text in enumerate(texts):
        plain = ["#" if w.isdigit() else "@" if w[0].isupper() else w for w in text.split()]
        for i, item in items:
            want = ["#" if w.isdigit() else "@" if w[0].isupper() else w for w in item.split()]
            shares = [sum(plain[s + k : s + k + 8] == want[k : k + 8] for k in range(len(want) - 7)) for s in range(len(plain) - len(want) + 1)]
            if max(shares) == len(want) - 7:
                expected.add((d, i))
    assert expected == {(i, i) for i in range(25)}
    assert set(found(spark, texts, items)) == expected
