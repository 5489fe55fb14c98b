import json
import random
from collections import Counter
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_texts import prose
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from asterlap.llm import packing as K
from asterlap.llm import token_counts as C
from asterlap.llm import token_records as T
from asterlap.llm.tokens import Tokens, spaced_words, worker_tokens, words

WORD, BYTE = (public_tokenizers.path(f) for f in (T.VOCABULARY, K.VOCABULARY))


def reference(path, texts):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def strange(n):
    rng = random.Random(9)
    parts = ["a", "Word", "don't", " ", "  ", "\n", "\n\n  ", "\t", "\x0b", "\xa0", "\x1c", " ", "　 ", "é", "é", "́", "Σ", "ΑΣ", "ß", "9", "12", "!", "...", "<|endoftext|>", "'s", "日本", "🙂", "\r\n", "İ"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(n)] + ["", " ", "x" * 5000, prose(1, 300)]


@pytest.mark.parametrize("path,pieces", [(WORD, words), (BYTE, spaced_words)])
def test_ids_are_those_of_whole_texts(path, pieces):
    texts = strange(3000)
    got = Tokens(path, pieces, limit=50)
    ids = [np.frombuffer(b, "<u4").tolist() for k in range(0, len(texts), 500) for b in got.encode(texts[k : k + 500])]
    assert ids == reference(path, texts)


def test_records_come_back_in_any_order(spark, documents, tmp_path):
    rng = random.Random(1)
    rows = [(i, prose(i, rng.randint(0, 50))) for i in range(200)]
    rng.shuffle(rows)
    path = f"file://{tmp_path}/records"
    index = T.write_records(documents(rows).repartition(3), path, WORD)
    ids = dict(zip([i for i, _ in rows], reference(WORD, [t for _, t in rows])))
    start = 0
    sums = {r.doc_id: r.ids_crc32 for r in T.read_checksums(index, path).collect()}
    for r in sorted(T.read_records(index.orderBy("size"), path).collect()):
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert own == ids[r.doc_id] + [1] and (r.start, r.n_tokens) == (start, len(own)) and sums[r.doc_id] == zlib.crc32(r.ids)
        start += len(own)
    assert T.read_records(index.filter("doc_id in (3, 77)"), path).count() == 2


def test_damaged_records_are_noticed():
    record = T.framed(b"some data")
    assert T.unframed(record) == b"some data" and T.unframed(T.framed(b"")) == b""
    for i in range(len(record)):
        with pytest.raises(ValueError):
            T.unframed(record[:i] + bytes([record[i] ^ 1]) + record[i + 1 :])


def test_odd_records(spark, odd, documents, tmp_path):
    df, rows = odd
    index = T.write_records(df, f"file://{tmp_path}/odd", WORD)
    got = sorted((str(r.doc_id), zlib.crc32(r.ids)) for r in T.read_records(index, f"file://{tmp_path}/odd").collect())
    ids = reference(WORD, [r[1] or "" for r in rows])
    assert got == sorted((str(r[0]), zlib.crc32(np.array(i + [1], "<u4").tobytes())) for r, i in zip(rows, ids))
    starts = [r.start for r in index.orderBy("start").collect()]
    assert starts[0] == 0 and len(set(starts)) == len(rows)
    assert T.write_records(documents([]), f"file://{tmp_path}/none", WORD).count() == 0


def check_packed(rows, texts, ids_by_doc):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for doc_id, ids in ids_by_doc.items():
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    return len(sequences)


def test_packing_is_whole_and_tight(documents, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_TOKENS", 5000)
    rng = random.Random(2)
    rows = [(i, prose(i, rng.choice([0, 5, 60, 900]))) for i in range(150)]
    ids = {i: x + [0] for (i, _), x in zip(rows, reference(BYTE, [t for _, t in rows]))}
    n = check_packed(K.pack(documents(rows).coalesce(1), BYTE).collect(), rows, ids)
    assert n <= 1.05 * sum(map(len, ids.values())) / 1024 + 1


def test_odd_packing(odd, documents):
    df, rows = odd
    got = K.pack(df, BYTE, with_ids=True).collect()
    assert sum(r.length for r in got) == sum(len(x) + 1 for x in reference(BYTE, [r[1] or "" for r in rows]))
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    assert K.pack(documents([]), BYTE).count() == 0


def test_cuts_are_the_cheapest():
    rng = random.Random(6)
    for _ in range(200):
        places = [0]
        while len(places) < rng.randint(2, 25):
            places.append(places[-1] + rng.randint(1, 10))
        costs = [0] + [rng.choice([0, 1, 5]) for _ in places[1:-1]] + [0]
        best = [0] + [10**9] * (len(places) - 1)
        for j in range(1, len(places)):
            for i in range(j):
                if places[j] - places[i] <= 16:
                    best[j] = min(best[j], best[i] + 16 - (places[j] - places[i]) + costs[j])
        cuts = K.best_cuts(np.array(places), np.array(costs), 16)
        at = {p: c for p, c in zip(places, costs)}
        assert cuts[0] == 0 and cuts[-1] == places[-1] and all(0 < b - a <= 16 for a, b in zip(cuts, cuts[1:]))
        assert sum(16 - (b - a) + at[b] for a, b in zip(cuts, cuts[1:])) == best[-1]


def greedy(word, starts, rests):
    i = n = 0
    known = starts
    while i < len(word):
        j = next((j for j in range(len(word), i, -1) if word[i:j] in known), None)
        if j is None:
            return 0
        i, n, known = j, n + 1, rests
    return n


def test_piece_counts_are_those_of_greedy_matching():
    rng = random.Random(8)
    some = lambda: {bytes(rng.choices(b"ab", k=rng.randint(1, 4))) for _ in range(rng.randint(1, 6))}
    for _ in range(1500):
        starts, rests = some(), some()
        automaton = C.LongestMatch(starts, rests)
        for _ in range(10):
            word = bytes(rng.choices(b"abc", (9, 9, 1), k=rng.randint(1, 14)))
            assert automaton.pieces(word) == greedy(word, starts, rests)


def marked_pieces(path):
    """Pieces with and without the end-of-word mark, read from the file by the library's own alphabet of bytes."""
    found = [p for p in json.load(open(path, encoding="utf-8"))["model"]["vocab"]]
    return {p[:-4] for p in found if p.endswith("</w>")} - {""}, {p for p in found if not p.endswith("</w>")}


def greedy_marked(word, ends, inner):
    """Longest first: the whole rest as a piece that ends a word, or else a piece that leaves some of it."""
    i = n = 0
    while i < len(word):
        if word[i:] in ends:
            return n + 1
        j = next((j for j in range(len(word) - 1, i, -1) if word[i:j] in inner), None)
        if j is None:
            return 0
        i, n = j, n + 1
    return n


def letters_of(word):
    """The word in the letters of byte-level vocabularies, by the library."""
    return "".join(p for p, _ in ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(word))


def test_piece_counts_of_documents(odd, documents):
    df, rows = odd
    texts = strange(300) + ["unhappinesses walking walkings a ab the thethe theth", "ing ingx xing ' ''", "日本語 étés été"]
    rows = [*rows, *((9000 + i, t) for i, t in enumerate(texts))]
    ends, inner = marked_pieces(WORD)
    assert len(ends - inner) > 20_000, "many pieces only end words"
    got = sorted((str(r.doc_id), r.n_words, r.n_tokens, r.n_unknown) for r in C.counts(documents([r[:2] for r in rows]), WORD).collect())
    known = {}

    def count(w):
        if w not in known:
            known[w] = greedy_marked(letters_of(w), ends, inner) if len(w) < 1000 else C.LongestMatch(*C.vocabulary(WORD)).pieces(w.encode())
        return known[w]

    split = [[w.decode() for w in (r[1] or "").lower().encode().split()] for r in rows]
    assert got == sorted((str(r[0]), len(ws), sum(max(1, count(w)) for w in ws), sum(not count(w) for w in ws)) for r, ws in zip(rows, split))
    assert C.counts(df, WORD).count() == len(rows) - len(texts) and C.counts(documents([]), WORD).count() == 0


def test_last_pieces_match_only_where_a_word_ends():
    rng = random.Random(9)
    some = lambda: {bytes(rng.choices(b"ab", k=rng.randint(1, 4))) for _ in range(rng.randint(1, 6))}
    for _ in range(1500):
        ends, inner = some(), some()
        whole = {C.ending(p) for p in ends} | {tuple(p) for p in inner}
        automaton = C.LongestMatch(whole, whole, True)
        for _ in range(10):
            word = bytes(rng.choices(b"abc", (9, 9, 1), k=rng.randint(1, 14)))
            assert automaton.pieces(word) == greedy_marked(word, ends, inner)


def test_ids_are_those_of_the_library_with_its_defaults(documents, tmp_path):
    texts = strange(1500) + ["a <|endoftext|> b", "A <|EndOfText|>b", "<|startoftext|>", "x" * 500 + "<|endoftext|>", " <|endoftext|> \n\n<|endoftext|>"]
    for path, pieces in ((WORD, words), (BYTE, spaced_words)):
        expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(b, "<u4").tolist() for b in worker_tokens(path, pieces).encode(texts)] == expected
    rows = [(i, t) for i, t in enumerate(texts[-5:])]
    index = T.write_records(documents(rows), f"file://{tmp_path}/added", WORD)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in T.read_records(index, f"file://{tmp_path}/added").collect()}
    assert got[0] == [320, 49407, 321, 1]
    assert sum(r.length for r in K.pack(documents(rows[:1]), BYTE).collect()) == 5


@pytest.mark.parametrize("length", [8, 16, 64])
def test_short_sequences(documents, length):
    """A stretch without a sentence end that is longer than a sequence is cut within."""
    rows = [(1, "ab " * 90), (2, prose(2, 200)), (3, ""), (4, "x" * 500)]
    got = K.pack(documents(rows), BYTE, length=length, with_ids=True).collect()
    assert sum(r.length for r in got) == sum(len(x) + 1 for x in reference(BYTE, [t for _, t in rows]))
    filled = Counter()
    for r in got:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= length


def test_pieces_are_looked_up_once():
    hashed = []

    class Piece(str):
        __slots__ = ()

        def __hash__(self):
            hashed.append(self)
            return super().__hash__()

    tokens = Tokens(BYTE, lambda text: [Piece(p) for p in spaced_words(text)], added_as_text=False)
    texts = ["one two one. " * 50, "two three 4 " * 50]
    expected = [e.ids for e in tokens.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [np.frombuffer(ids, "<u4").tolist() for ids in tokens.encode(texts)] == expected
    occurrences = 2 * sum(len(spaced_words(t)) for t in texts)
    assert len(hashed) < 1.2 * occurrences


def test_failed_encoding_leaves_no_empty_pieces(monkeypatch):
    tokens = Tokens(BYTE, spaced_words, added_as_text=False)
    with monkeypatch.context() as broken:
        broken.setattr(tokens, "bare", None)
        with pytest.raises(AttributeError):
            tokens.encode(["some text"])
    assert np.frombuffer(tokens.encode(["some text"])[0], "<u4").tolist() == tokens.tokenizer.encode("some text", add_special_tokens=False).ids
