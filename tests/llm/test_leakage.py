import random
from collections import Counter

from tarazu.llm.leakage import Items, chain, find_leaks, tiles, words


def brute_tiles(item, doc, least):
    """Greedy string tiling straight from its definition."""
    free_i, free_j, out = [True] * len(item), [True] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and free_i[i + n] and free_j[j + n]:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (i, j, n)
        if best is None:
            return out
        out.append(best)
        for k in range(best[2]):
            free_i[best[0] + k] = free_j[best[1] + k] = False


def test_tiling_covers_what_its_definition_covers():
    rng = random.Random(1)
    for _ in range(300):
        item = [rng.randrange(6) for _ in range(rng.randrange(1, 14))]
        doc = [rng.randrange(-1, 6) for _ in range(rng.randrange(1, 20))]
        got, want = tiles(item, [x if x >= 0 else -1 for x in doc], 2), brute_tiles(item, doc, 2)
        assert sum(n for *_, n in got) == sum(n for *_, n in want), (item, doc, got, want)
        assert all(item[i : i + n] == doc[j : j + n] for i, j, n in got)


def test_chain_keeps_the_order():
    assert chain([(0, 10, 3), (3, 0, 5), (8, 20, 2)]) == [(3, 0, 5), (8, 20, 2)]
    assert chain([]) == []


ITEM = "the quick brown fox of lamar jumps over nine lazy dogs while zelda watches the river quietly tonight"
ROWS = [
    (1, f"before {ITEM} after", "d"), (2, ITEM.replace(" ", " ").upper(), "d"), (3, "something else entirely", "d"), (4, None, "d"), (5, "", "d"), (6, "...", "d"),
    (7, " ".join(ITEM.split()[:7]), "d"), (8, " ".join(ITEM.split()[8:] + ["x"] * 5 + ITEM.split()[:8]), "d"),
    (9, " ".join(ITEM.split()[:9] + ["other", "words", "here"] + ITEM.split()[9:]), "d"), (10, "x " * 50_000 + ITEM, "d"), (1, f"before {ITEM} after", "d"),
]


SHORT = [(20, "alpha beta", "q"), (21, "omega", "q"), (22, " ".join(f"w{i}" for i in range(20)), "q")]


def test_operator_in_one_block_and_many(spark):
    scattered = " ".join("changed" if i % 3 == 2 else f"w{i}" for i in range(20))  # 14 of 20 words, two at a time
    rows = [*ROWS, (11, "so alpha beta went", "d"), (12, "OMEGA", "d"), (13, scattered, "d"), (14, " ".join(f"w{i}" for i in (*range(10, 16), *range(4, 10))), "d"), (None, ITEM, "d"), (2**60 + 1, ITEM, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(5, ITEM, "q"), (6, None, "q"), (7, "", "q"), (8, "...", "q"), *SHORT, (5, ITEM, "q"), (9, ITEM, "q"), (None, "alpha beta", "q")], "item_id long, text string, doc_id string")
    of_item = [(d, i) for d in (1, 1, 2, 8, 9, 10, None, 2**60 + 1) for i in (5, 5, 9)]
    want = Counter([*of_item, (11, 20), (11, None), (12, 21), (13, 22)])
    for size in (1 << 20, 200):
        got = find_leaks(docs, items, block_bytes=size).collect()
        assert Counter((r.doc_id, r.item_id) for r in got if r.in_order) == want, size
        moved = next(r for r in got if r.doc_id == 14)
        assert not moved.in_order and (round(moved.coverage, 2), round(moved.tiled, 2)) == (0.3, 0.6)
    assert find_leaks(docs.limit(0), items).count() == 0 and find_leaks(docs, items.limit(0)).count() == 0


def brute_found(rows, text):
    """Items by the definition: tiles of two words, the best chain, no bounds and no seeds."""
    out = []
    doc = words(text)
    for k, (ws, own) in enumerate(rows):
        t = brute_tiles(ws, doc, min(2, len(ws)))
        at = sorted(p for i, _, n in chain(t) for p in range(i, i + n))
        if len(at) > 0.5 * len(ws) and sum(ws[p] in own for p in at) >= 0.25 * sum(w in own for w in ws[at[0] : at[-1] + 1]):
            out.append(k)
    return out


def test_bounds_lose_nothing():
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(9)]
    for _ in range(300):
        rows = [([rng.choice(vocab) for _ in range(rng.randrange(1, 12))], rng.sample(vocab, 4)) for _ in range(4)]
        text = " ".join(rng.choice([*vocab, "zz"]) for _ in range(rng.randrange(0, 25)))
        assert [k for k, *_, ok in Items(rows).found(text) if ok] == brute_found(rows, text)


def test_words():
    assert words("Rs. 2,020,442 केशार्‍याल (२०)!") == ["rs", "2020442", "केशार्याल", "20"]
    assert words(None) == words("... ।") == []


def test_moulds_are_no_leaks(spark):
    mould = "years later {} was puzzled to learn that {} of {} crates of {} had vanished and left the remaining {} in a shed"
    items = spark.createDataFrame([(i, mould.format(f"name{i}", i + 100, i + 200, f"noun{i}", f"thing{i}")) for i in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(1, mould.format("elsewho", 1, 2, "coal", "wood")), (2, mould.format("name7", 107, 207, "noun7", "thing7"))], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in find_leaks(docs, items).collect()] == [(2, 7)]


def test_half_without_the_rare_words_is_a_leak():
    shared = "years later the clerk was puzzled to learn that the whole store had vanished from the shed"
    rows = [(words(f"{shared} while name{i} of place{i} counted crate{i} near river{i} with child{i}"), [f"{w}{i}" for w in ("name", "place", "crate", "river", "child")]) for i in range(60)]
    assert [k for k, *_, ok in Items(rows).found(f"before {shared} and nothing more") if ok] == list(range(60))
