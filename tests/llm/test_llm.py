"""Problems 6 to 8 on small corpora: round trips, brute force, held-out accuracy, dirty and empty input."""

import os
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillwork.llm import leakage, packing, sentences
from rillwork.llm.tokens import TOKENIZER, TOKENIZER_FOLDER, counter, encoding

DOC = "doc_id bigint, text string, id string, window bigint, lang string"


def _docs(spark, texts):
    return spark.createDataFrame([(k, t, "x", 1, None) for k, t in enumerate(texts)], DOC)


# Problem 6 ------------------------------------------------------------------------------------------------


def _check_packing(rows, sizes, capacity):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        if r.seq_id is not None:
            by_seq[r.seq_id].append(r)
    assert by_doc.keys() == sizes.keys()
    for doc, parts in by_doc.items():
        parts.sort(key=lambda r: r.piece)
        assert sum(r.n_tokens for r in parts) == sizes[doc]
        assert [r.first_token for r in parts] == list(np.cumsum([0, *(r.n_tokens for r in parts)])[:-1])
        assert len(parts) == max(1, -(-sizes[doc] // capacity))
        assert all((r.seq_id is None) == (sizes[doc] == 0) for r in parts)
    for parts in by_seq.values():
        parts.sort(key=lambda r: r.position)
        at = 0
        for r in parts:
            assert r.position == at
            at += r.n_tokens
        assert at <= capacity
    return len(by_seq)


def test_packing_round_trip(spark):
    rnd = random.Random(1)
    texts = ["word " * rnd.choice([1, 3, 7, 20, 50, 63, 64, 65, 200]) for _ in range(400)] + ["", None, "   ", "word " * 5000] + ["same text here"] * 50
    count = counter(f"{TOKENIZER_FOLDER}/{TOKENIZER}")
    sizes = {k: count(t) for k, t in enumerate(texts)}
    rows = packing.pack(_docs(spark, texts).repartition(5), capacity=64, space=2, merge=8).collect()
    n = _check_packing(rows, sizes, 64)
    assert n <= sum(sizes.values()) / 64 * 1.1 + 4


def test_tokens_of_long_texts_are_those_of_the_tokenizer():
    path = f"{TOKENIZER_FOLDER}/{TOKENIZER}"
    count = counter(path)
    for text in ("word " * 300_000, "abcd" * 300_000, "one line\n" * 150_000, "  \n" * 400_000):
        assert count(text) == len(encoding(path).encode_ordinary(text)) and len(text) > 1 << 20
    assert count("word " * 300_000) == 300_001 and count(None) == count("") == 0


def test_packing_is_the_same_in_every_run(spark):
    texts = ["word " * (k * 7 % 90) for k in range(300)]
    docs = _docs(spark, texts).coalesce(1)
    runs = [sorted(map(tuple, packing.pack(docs, capacity=64, space=4).select("doc_id", "piece", "seq_id", "position").collect()), key=repr) for _ in range(2)]
    assert runs[0] == runs[1]


def test_packing_of_nothing(spark):
    assert packing.pack(_docs(spark, []), capacity=64).count() == 0
    assert [r.seq_id for r in packing.pack(_docs(spark, ["", None]), capacity=64).collect()] == [None, None]


@given(st.lists(st.integers(1, 20), max_size=60), st.integers(1, 5))
@settings(max_examples=60, deadline=None)
def test_open_windows_hold_everything_once(sizes, space):
    w = packing.OpenWindows(20, space, 0)
    done = [x for k, s in enumerate(sizes) for x in w.place(s, k)]
    windows = done + w.rest()
    assert sorted(i for _, items in windows for i, _ in items) == list(range(len(sizes)))
    for _, items in windows:
        at = 0
        for i, start in items:
            assert start == at
            at += sizes[i]
        assert at <= 20
    assert len(w.rest()) <= space


# Problem 7 ------------------------------------------------------------------------------------------------


@given(st.lists(st.integers(0, 3), max_size=60))
@settings(max_examples=100, deadline=None)
def test_suffix_array_is_sorted(ids):
    a = np.array(ids, dtype=np.int64)
    order = leakage.suffix_array(a, 8) if len(a) else a
    got = [tuple(ids[k : k + 8]) for k in order]
    assert got == sorted(got) and sorted(order.tolist()) == list(range(len(ids)))


def test_leaks_against_brute_force(spark):
    rnd = random.Random(3)
    vocabulary = [f"w{k}" for k in range(40)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(k, "en", text(30)) for k in range(12)] + [(20, "zh", "".join(chr(0x4E00 + rnd.randrange(300)) for _ in range(60))), (21, "en", "too short"), (22, "en", None), (23, "zh", "")]
    docs = [text(rnd.randrange(0, 80)) for _ in range(60)]
    docs += [text(9) + " " + " ".join(items[k % 12][2].upper().split()[j : j + rnd.randrange(10, 16)]).replace(" ", ",  ", 3) + " " + text(5) for k, j in ((k, k % 9) for k in range(40))]
    zh = items[12][2]
    docs += ["前言。" + zh[10:34] + "！", zh[5:20] + "，" + zh[20:40], zh[:23], None, "", "​" + items[0][2].replace("w1", "w​1", 1).replace(" ", "­ ", 1)]
    docs += [items[3][2]] * 3 + [text(3000) + " " + items[4][2] + " " + text(3000)]
    frame = spark.createDataFrame(items, "item_id bigint, lang string, text string")
    for shard in (1_000_000, 200):
        got = {(r.item_id, r.doc_id): r for r in leakage.leaks(_docs(spark, docs).repartition(3), frame, shard=shard).collect()}
        want = {}
        for i, lang, t in items:
            split = leakage.letters if lang == "zh" else leakage.words
            least = 24 if lang == "zh" else 12
            a = split(t or "")
            for d, u in enumerate(docs):
                b = split(u or "")
                best = ()
                for p in range(len(a) - least + 1):
                    for q in range(len(b) - least + 1):
                        if a[p : p + least] == b[q : q + least]:
                            n = least
                            while p + n < len(a) and q + n < len(b) and a[p + n] == b[q + n]:
                                n += 1
                            best = min(best or (0, 0, 0), (-n, p, q))
                if best:
                    want[i, d] = best
        assert {k: (-r.length, r.item_pos, r.doc_pos) for k, r in got.items()} == want
    clean = {r.doc_id for r in leakage.without_leaks(_docs(spark, docs), spark.createDataFrame([(d,) for _, d in want], "doc_id bigint")).collect()}
    assert clean == set(range(len(docs))) - {d for _, d in want}


def test_blocks_of_items_hold_a_bounded_text(spark):
    items = [(k, "en", " ".join(f"w{k}x{j}" for j in range(14))) for k in range(6)]
    frame = spark.createDataFrame(items, "item_id bigint, lang string, text string")
    assert [len(b) for b in leakage._blocks(frame, ("zh",), 200)] == [2, 2, 2]
    docs = _docs(spark, [t for _, _, t in items])
    assert {(r.item_id, r.doc_id) for r in leakage.leaks(docs, frame, block=200).collect()} == {(k, k) for k in range(6)}


def test_leaks_of_nothing(spark):
    items = spark.createDataFrame([(1, "en", "a b c d e f g h i j k l m")], "item_id bigint, lang string, text string")
    assert leakage.leaks(_docs(spark, []), items).count() == 0
    assert leakage.leaks(_docs(spark, ["a b c d e f g h i j k l m"]), items.limit(0)).count() == 0


# Problem 8 ------------------------------------------------------------------------------------------------

NAMES = ["Holvik", "Brenz", "Quarn", "Velmar", "Orvelle", "Drusk", "Pikhart", "Tessivar"]


def _corpus(seed, n=400):
    """Texts with known units."""
    rnd = random.Random(seed)
    name = lambda: rnd.choice(NAMES)
    kinds = [
        lambda: f"Dr. {name()} saw the weir at {name()}.",
        lambda: f"The gate rose {rnd.randrange(99)}.{rnd.randrange(9)} m near St. {name()} in {rnd.randrange(1900, 2020)}.",
        lambda: f"See fig. {rnd.randrange(99)} and no. {rnd.randrange(99)}, e.g. the old one.",
        lambda: f'"Who closed it?" asked Ms. {name()} at noon.',
        lambda: f"It was built by {name()} Ltd.",
        lambda: "Why did it fail?",
        lambda: f"“The basin is full. We must wait,” said {name()}.",
        lambda: f"The rule (it was short. It held.) was kept by {name()}.",
        lambda: "Wait... the pump ran again.",
        lambda: f"[Ed. note: not shown. Ask {name()}.]",
    ]
    texts, truth = [], []
    for _ in range(n):
        text, units = "", []
        for _ in range(rnd.randrange(1, 6)):
            if text:
                text += rnd.choice(["\n", "\n\n", "\r\n"])
            if rnd.random() < 0.2:
                mark = f"{rnd.randrange(1, 9)}. "
            else:
                mark = ""
            for k in range(rnd.randrange(1, 5)):
                if k:
                    text += rnd.choice([" ", " ", "  ", " "])
                unit = (mark if not k else "") + rnd.choice(kinds)()
                units.append((len(text), len(text) + len(unit)))
                text += unit
        texts.append(text)
        truth.append(set(units))
    return texts, truth


def test_sentences_on_held_out_texts(spark):
    train, _ = _corpus(1)
    model = sentences.train(_docs(spark, train), sample=300)
    texts, truth = _corpus(2, 150)
    got = defaultdict(set)
    for r in sentences.sentences(_docs(spark, texts), model).collect():
        got[r.doc_id].add((r.start_pos, r.end_pos))
    hit = sum(len(got[k] & t) for k, t in enumerate(truth))
    found, there = sum(map(len, got.values())), sum(map(len, truth))
    assert hit / found > 0.97 and hit / there > 0.97


def test_units_cover_every_character_once(spark):
    texts, _ = _corpus(3, 60)
    texts += ["", None, "  \n\t", "a" * 100_000, "x. " * 20_000, "。" * 50, "\r\n.\r\n", "¿Qué? ¡No!Sí.", "ท่อ เต็ม 5 คลอง ปิด", "「待とう。」と言った。次。", "Â»Wehr voll!Â«, rief er. Â»Ja.Â« Gut."] + ["Same. Text."] * 3
    rows = sentences.sentences(_docs(spark, texts)).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append((r.start_pos, r.end_pos))
    for k, t in enumerate(texts):
        t = t or ""
        at, seen = 0, []
        for a, b in sorted(by[k]):
            assert a >= at and b > a and not t[a].isspace() and not t[b - 1].isspace() and not t[at:a].strip()
            at = b
            seen.append(t[a:b])
        assert not t[at:].strip()


@pytest.mark.parametrize(
    "text, want",
    [
        ("ท่อเต็ม คลองปิด 25 ที่ประตู", ["ท่อเต็ม", "คลองปิด 25 ที่ประตู"]),
        ("水位上升（见图5.4。下同）。请注意！快走", ["水位上升（见图5.4。下同）。", "请注意！", "快走"]),
        ("Start » Karte » Brenz Ltd. » Kontakt", ["Start » Karte » Brenz Ltd. » Kontakt"]),
        ("»Pegel undicht!«, rief man.", ["»Pegel undicht!«, rief man."]),
        ("a\nb\r\nc\u2028d", ["a", "b", "c", "d"]),
        ("Version 2.14.8 of www.x.example/1.html today", ["Version 2.14.8 of www.x.example/1.html today"]),
    ],
)
def test_fixed_rules(text, want):
    model = sentences.Model(np.zeros(sentences._WIDTH, dtype=np.float32), 1.0, sentences.Statistics(*[np.zeros(sentences.SLOTS)] * 7).graded())
    _, a, b = sentences.units([text], model)
    assert [text[i:j] for i, j in sorted(zip(a.tolist(), b.tolist()))] == want


def test_repaired_lines():
    meant, where = sentences.repaired("Ã¼ber â€œKanalâ€\x9d 5")
    assert meant == "über “Kanal” 5" and where[0] == 0 and where[1] == 2 and where[-1] == len("Ã¼ber â€œKanalâ€\x9d 5")
    assert sentences.repaired("plain") == ("plain", None)


def test_garbled_line_of_wide_marks_is_split():
    text = "".join(bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in "水位。流量".encode())
    model = sentences.Model(np.zeros(sentences._WIDTH, dtype=np.float32), 1.0, sentences.Statistics(*[np.zeros(sentences.SLOTS)] * 7).graded())
    _, a, b = sentences.units([text], model)
    assert sorted(zip(a.tolist(), b.tolist())) == [(0, 9), (9, 15)]


def test_no_documents(spark):
    assert sentences.sentences(_docs(spark, [])).count() == 0


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no test data")
@pytest.mark.parametrize("name", ["p7_found", "p7_clean"])
def test_query_equals_sql(spark, name):
    from oracle import compare

    from rillwork.llm import queries

    assert compare(spark, "/root/testdata/sf0.001", name, queries.QUERIES[name], queries.ORACLE[name]) == ""
