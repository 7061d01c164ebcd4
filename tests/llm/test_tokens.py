"""Alignment, packing and spelling variants against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from listmill.llm import alignment, packing, spelling
from listmill.llm.tokens import WordIds, Words, byte_letters, read_file

TEXTS = [
    None,
    "",
    " ",
    "a",
    "  ",
    "hello  world\n\tfoo",
    " leading",
    "trailing ",
    "日本語 テスト",
    "a▁b",
    "\xa0x y",
    "ﬁ é é é",
    "a\x00b \x01",
    "�",
    "<s> x <unk> <|endoftext|> y<|startoftext|>",
    "foo\n \nbar",
    "foo \nbar",
    "foo\n bar",
    "it's don't I'LL 's",
    "x" * 9000,
    "a b " * 3000,
    "Straße Übung. naïve, coöp; 'quoted' ª º µ ×÷ 12 ½ ² ÀÉÎ",
    "   　 \x85 z",
    "emoji 👩‍👩‍👧 ok",
    "İI ςΣ ΑΣ ΑΣ.",
    "\r\n \x0b \x0c x\x1c y",
    "hello  world\n\tfoo",
]


def documents(spark, texts):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, piece string, n int")


def table_rows(spark, sf="sf0.001"):
    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    return [r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def expected_alignment(texts):
    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = {c: b for b, c in byte_letters().items()}
    rows, counts = [], Counter()
    for text in texts:
        text = text or ""
        a = a_side.encode(" " + text, add_special_tokens=False)
        b = b_side.encode(text)
        a_bytes = [bytes(letters[c] for c in t) for t in a.tokens]
        pieces = [b_side.id_to_piece(i) for i in b]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()
            for p, i in zip(pieces, b, strict=True)
        ]
        whole = (" " + text).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            rows.append(None)
            continue
        a_ends, b_ends = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
        links, groups, own = [], [], ([], [])
        i = j = 0
        while i < len(a_ends):
            links.append((a.ids[i], b[j]))
            end = min(a_ends[i], b_ends[j])
            both = a_ends[i] == b_ends[j]
            if a_ends[i] == end:
                own[0].append(str(a.ids[i]))
                i += 1
            if b_ends[j] == end:
                own[1].append(str(b[j]))
                j += 1
            if both:
                groups.append(",".join(own[0]) + "|" + ",".join(own[1]))
                own = ([], [])
        counts.update(links)
        rows.append((len(a.ids), len(b), len(groups), len(links), ";".join(groups), links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    found = []
    for row in rows:
        if row is None:
            found.append((0, 0, 0, 0, 0, 0, ""))
        else:
            *numbers, groups, links = row
            n_best = sum(counts[link] == best[link[1]] for link in links)
            found.append((*numbers, n_best, sum(counts[link] for link in links), groups))
    return found


ALIGNED = "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"


def aligned(df, **options):
    rows = alignment.align(df, **options).documents.select(*ALIGNED).collect()
    return [tuple(r)[1:] for r in sorted(rows)]


def test_alignment_of_odd_texts(spark):
    assert aligned(documents(spark, TEXTS)) == expected_alignment(TEXTS)


def test_alignment_of_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(alignment, "PIECE_BYTES", 1 << 14)
    texts = table_rows(spark)
    expected = [
        (*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else "")
        for row in expected_alignment(texts)
    ]
    assert aligned(documents(spark, texts).repartition(3), digest=True) == expected


def test_alignment_pairs(spark):
    found = alignment.align(documents(spark, ["a b", "a b", None]))
    rows = {(r["links"], r["best"]) for r in found.pairs.collect()}
    assert rows == {(2, True)} and found.pairs.count() == 2


def test_alignment_of_nothing(spark):
    assert aligned(documents(spark, [])) == []
    assert aligned(documents(spark, [None, ""])) == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_model_that_goes_on_behind_a_space(monkeypatch):
    class Model:
        def __init__(self, model_proto):
            pass

        def piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"

    monkeypatch.setattr(alignment, "SentencePieceProcessor", Model)
    with pytest.raises(ValueError, match="behind a space"):
        alignment.piece_side(b"")


def packed(df, **options):
    pieces, places = defaultdict(list), defaultdict(list)
    for r in packing.pack(df, **options).collect():
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    return pieces, places


def check_packing(texts, pieces, places, capacity=4096):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            own = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], len(own), r["doc_tokens"]) == (at, 4 * r["length"], len(ids))
            assert zlib.crc32(own) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    assert sorted(places) == list(range(len(places)))
    short = 0
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity and end & (end - 1) == 0
        short += end < capacity
    # only what is behind the last full bin of each class
    assert short <= capacity.bit_length() ** 2 / 2


@pytest.mark.parametrize("texts", [TEXTS, None], ids=["odd", "table"])
def test_packing_covers_every_token_without_padding(spark, texts):
    texts = table_rows(spark) if texts is None else texts
    check_packing(texts, *packed(documents(spark, texts).repartition(5)))


def test_packing_bins_have_a_fixed_count(spark):
    _, places = packed(documents(spark, table_rows(spark)), capacity=256)
    sizes = {tuple(sorted({n for _, n in parts})) for parts in places.values()}
    assert all(len(own) == 1 for own in sizes)
    check_packing([], {}, places, 256)


def test_packed_sequences_spell_the_documents(spark):
    pieces = packing.pack(documents(spark, ["x y z " * 3000, None]), capacity=1024, keep_ids=True)
    rows = packing.sequences(pieces).collect()
    whole = np.concatenate([r["ids"] for r in sorted(rows)])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = tokenizer.encode("x y z " * 3000, add_special_tokens=False).ids + [2, 2]
    assert sorted(whole.tolist()) == sorted(expected)
    assert max(len(r["ids"]) for r in rows) == 1024


def test_packing_of_nothing_and_repeated_rows(spark):
    assert packing.pack(documents(spark, [])).collect() == []
    twice = spark.createDataFrame([(None, None), (7, "a"), (7, "a")], "doc_id long, text string")
    rows = packing.pack(twice).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 1), (7, 2), (7, 2)]
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(twice, capacity=100)


def expected_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_variants(rows):
    counts = expected_words(rows)
    by_part = defaultdict(set)
    for w in counts:
        for part in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            by_part[part].add(w)
    near = defaultdict(set)
    for group in by_part.values():
        for a in group:
            near[a] |= {b for b in group if b != a and one_edit(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    found = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        found.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return found


VARIANT = "word", "form", "root", "n", "n_near", "form_n"


def check_variants(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string")
    found = [tuple(r) for r in spelling.spelling_variants(df).select(*VARIANT).collect()]
    assert len(found) == len(set(found))
    assert set(found) == expected_variants(rows)


def test_variants_of_the_table(spark):
    check_variants(spark, list(enumerate(table_rows(spark))))


def test_variants_of_odd_texts(spark):
    texts = [
        None,
        "",
        "aaaaa aaaaaa aaaaaaa aaaaaaaa " * 5,
        "×÷×÷× Straße straße STRASSE àéîõü ÀÉÎÕÜ" * 4,
        "colour color colours Colour colou " * 9,
        # a chain: each form twice as frequent
        "abcde " * 40 + "abcdf " * 20 + "abcgf " * 10 + "ahcgf " * 5,
        # a tie between two forms
        "hallo " * 8 + "hullo " * 8 + "hollo " * 4,
    ]
    rows = [*enumerate(texts), *[(None, "colour Color")] * 3, *[(2, "x" * 4000 + " ")] * 3]
    check_variants(spark, rows)
    check_variants(spark, [])


@pytest.mark.parametrize("alphabet", ["ab", "abcé"])
def test_near_words_share_more_grams_than_are_affected(spark, alphabet):
    """Few letters make grams frequent, so they get long and cover each other."""
    rng = np.random.default_rng(5)
    words = {"".join(rng.choice(list(alphabet), rng.integers(5, 11))) for _ in range(700)}
    found = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    dictionary = spelling.gram_dictionary(found)
    assert any(len(gram) == spelling.LONGEST for gram in dictionary)
    grams = {w: spelling.decompose(w, dictionary) for w in words}
    pairs = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    for a, b in pairs:
        common = sum((Counter(g for _, g in grams[a]) & Counter(g for _, g in grams[b])).values())
        for w in (a, b):
            bound = spelling.affected(grams[w], len(w))
            assert common >= len(grams[w]) - bound >= 1
    rows = spelling.near_pairs(found).collect()
    assert {tuple(sorted((r["word"], r["other"]))) for r in rows} == pairs and len(rows) == len(pairs)


def test_frequent_words_stay_known():
    asked = []

    def encode(words):
        asked.extend(words)
        return [[len(w)] for w in words]

    ids = WordIds(encode, limit=8)
    for i in range(50):
        assert ids.of_words(pa.array(["the", f"w{i}"])).to_pylist() == [[3], [len(f"w{i}")]]
        assert len(ids.known) + len(ids.older) <= 8 + 4
    assert asked.count("the") == 1


def test_alignment_loads_its_models_once_in_a_worker():
    byte_level, pieces = read_file(alignment.BYTE_LEVEL), read_file(alignment.PIECES)
    first = alignment._sides(byte_level, pieces)
    assert alignment._sides(bytes(bytearray(byte_level)), bytes(bytearray(pieces))) is first


def test_words_are_split_and_told_apart_once_for_both_tokenizers(monkeypatch):
    made = []
    of = Words.of.__func__
    monkeypatch.setattr(Words, "of", classmethod(lambda cls, words: made.append(1) or of(cls, words)))
    sides = alignment._sides(read_file(alignment.BYTE_LEVEL), read_file(alignment.PIECES))
    texts = pa.array(["", "one two one", None, " tied  words ", "two"])
    columns, *_ = alignment._aligned(texts, *sides, False)
    assert len(made) == 1
    assert [n > 0 for n in columns[0].to_pylist()] == [False, True, False, True, True]


def test_ids_of_a_slice_of_texts_come_in_order_of_its_words():
    texts = pa.array([["x"], ["bb", "a", "bb"], [], ["ccc", "a"]])
    ids = WordIds(lambda words: [[len(w)] * len(w) for w in words], limit=4)
    for _ in range(3):  # words that are new, known, and known from before
        assert ids.of_texts(texts[1:]).to_pylist() == [[2, 2, 1, 2, 2], [], [3, 3, 3, 1]]
