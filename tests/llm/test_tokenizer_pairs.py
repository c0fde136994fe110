"""Ops 11 and 13 against the libraries, and long words that an algebraic hash would confuse."""

import hashlib
import itertools
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from battlelake.llm import alignment, bpe, bytesets, decontaminate, near_dup, piece_cache, pieces, token_files

JSON, MODEL, RANKS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def byte_level():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    return library


@pytest.fixture(scope="module")
def sentence_pieces():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=MODEL)


def strange(rng, n, alphabet="ab the ▁ \t\n é日本語🙂´ﬁ́①　½x y z  <s></s><0x41>\x00ｱﾞ"):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


LONG = ["the " * 50, " ", "   ", "▁", "▁▁ a", "x" * 300, "日" * 200, "thean" * 400]


def with_normaliser(rule, fewer, prefix):
    """The model file with another normaliser: a compiled character map of the library's own."""
    from sentencepiece import SentencePieceNormalizer

    def varint(n):
        out = b""
        while True:
            n, low = n >> 7, n & 127
            out += bytes([low | (128 if n else 0)])
            if not n:
                return out

    own = SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec
    charsmap = dict(pieces._fields(own() if callable(own) else own))[2]
    spec = b"\x12" + varint(len(charsmap)) + charsmap + b"\x18" + bytes([prefix]) + b"\x20" + bytes([fewer]) + b"\x28\x01"
    with open(MODEL, "rb") as file:
        return file.read() + b"\x1a" + varint(len(spec)) + spec


def test_pieces_spans_and_texts_equal_the_library(rng, tmp_path, sentence_pieces):
    from sentencepiece import SentencePieceProcessor

    texts = strange(rng, 400) + LONG
    cases = [(sentence_pieces, pieces.encoder(MODEL))]
    for number, (rule, fewer, prefix) in enumerate(itertools.product(("nmt_nfkc", "nfkc_cf"), (0, 1), (0, 1))):
        path = tmp_path / f"{number}.model"
        path.write_bytes(with_normaliser(rule, fewer, prefix))
        cases.append((SentencePieceProcessor(model_file=str(path)), pieces.Encoder(str(path))))
    for library, own in cases:
        for text, (ids, begins, ends) in zip(texts, own.encode(texts), strict=True):
            want = [(p.id, p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
            assert list(zip(ids.tolist(), begins.tolist(), ends.tolist(), strict=True)) == want, text
            framed = [1, *ids.tolist(), 2]
            assert own.decode(np.array(framed)) == library.decode(framed)


def test_any_ids_decode_as_in_the_library(rng, sentence_pieces):
    own = pieces.encoder(MODEL)
    for _ in range(1500):
        ids = [rng.choice([0, 1, 2, 3 + rng.randrange(256), 3 + rng.randrange(256), rng.randrange(32000)]) for _ in range(rng.randint(0, 12))]
        assert own.decode(np.array(ids, np.int64)) == sentence_pieces.decode(ids), ids
    with pytest.raises(ValueError):
        own.decode(np.array([32000]))


def test_forgetting_units_changes_nothing(rng, monkeypatch, sentence_pieces):
    monkeypatch.setattr(pieces, "MAX_UNITS", 20)
    own, texts = pieces.Encoder(MODEL), strange(rng, 60) + LONG
    for at in range(0, len(texts), 5):
        assert [ids.tolist() for ids, _, _ in own.encode(texts[at:at + 5])] == [sentence_pieces.encode(t) for t in texts[at:at + 5]]


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_piece_report_equals_the_library(odd_docs, real_docs, no_docs, sentence_pieces):
    sha = lambda data: hashlib.sha256(data).hexdigest()
    for docs in (odd_docs, real_docs, no_docs):
        want = []
        for doc_id, text in rows_of(docs):
            ids = [1, *sentence_pieces.encode(text or ""), 2]
            want.append((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(sentence_pieces.decode(ids).encode())))
        assert sorted((tuple(r)[:4] for r in pieces.report(docs, MODEL).collect()), key=str) == sorted(want, key=str)


def test_pieces_keep_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a tale", [9], "x"), (2, None, None, None)], "doc_id long, text string, ids array<int>, decoded string")
    coded = pieces.encode(docs, MODEL)
    assert coded.columns == [*docs.columns, "_ids", "begins", "ends"]
    back = pieces.decode(coded, MODEL, "_ids").orderBy("doc_id").collect()
    assert [(r["ids"], r["_decoded"], r["ends"][-1:]) for r in back] == [([9], "a tale", [6]), (None, "", [])]


def aligned_by_hand(rows, byte_level, sentence_pieces):
    from tokenizers import pre_tokenizers

    assert len(pre_tokenizers.ByteLevel.alphabet()) == 256
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in keep} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in keep)}
    docs, holding = [], Counter()
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        a = byte_level.encode(" " + (text or ""), add_special_tokens=False).ids
        b = sentence_pieces.encode(text or "")
        raw_a = [bytes(signs[c] for c in byte_level.id_to_token(i)) for i in a]
        raw_b = [bytes([int(p[3:5], 16)]) if sentence_pieces.is_byte(i) else p.replace("▁", " ").encode()
                 for i, p in ((i, sentence_pieces.id_to_piece(i)) for i in b)]
        if not text or b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            docs.append((doc_id, 0, 0, 0, [], ""))
            continue
        ends_a, ends_b = (list(itertools.accumulate(map(len, raw))) for raw in (raw_a, raw_b))
        links = [(x, y) for x, e, n in zip(a, ends_a, raw_a, strict=True) for y, f, m in zip(b, ends_b, raw_b, strict=True)
                 if max(e - len(n), f - len(m)) < min(e, f)]
        groups, last = [], 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            own = [",".join(str(i) for i, e in zip(ids, ends, strict=True) if last < e <= cut) for ids, ends in ((a, ends_a), (b, ends_b))]
            groups.append("|".join(own))
            last = cut
        docs.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        holding.update(set(links))
    most = Counter()
    for (x, _), n in holding.items():
        most[x] = max(most[x], n)
    return [(doc_id, na, nb, ng, len(links), sum(holding[p] == most[p[0]] for p in links), sum(holding[p] for p in links), digest)
            for doc_id, na, nb, ng, links, digest in docs]


def test_alignment_equals_brute_force(spark, odd_docs, real_docs, no_docs, rng, byte_level, sentence_pieces):
    few = real_docs.where("length(text) < 1500").limit(60)
    marks = spark.createDataFrame([(20, "a ▁ mark"), (21, "<s>a</s> <|endoftext|>"), (22, "it it it it it"), *((30 + i, t) for i, t in enumerate(strange(rng, 80)))],
                                  "doc_id long, text string")
    short_odd = odd_docs.where("text IS NULL OR length(text) < 5000")
    for docs in (short_odd.select("doc_id", "text").union(marks), few, no_docs):
        want = aligned_by_hand(rows_of(docs), byte_level, sentence_pieces)
        assert sorted((tuple(r) for r in alignment.report(docs, JSON, MODEL).collect()), key=str) == sorted(want, key=str)


def test_small_blocks_give_the_same(spark, real_docs):
    """Blocks of eight documents, in many tasks: counts go over all blocks, bitmaps are bits as well as lists."""
    docs = real_docs.where("length(text) < 1500").limit(60)
    whole = sorted((tuple(r) for r in alignment.report(docs, JSON, MODEL).collect()), key=str)
    parted = sorted((tuple(r) for r in alignment.report(docs.repartition(7, "doc_id"), JSON, MODEL).collect()), key=str)
    assert whole == parted
    one = alignment.Block(0, 10)
    places = np.arange(600)
    one.add(np.concatenate((places, places[:5], places[:5])), np.concatenate((places * 0, places[:5] * 0, places[:5] * 0)), np.ones(610, np.int64))
    rows = list(one.rows())
    assert [r.column("n_docs").to_pylist() for r in rows] == [[600], [], [5]] or [r.column("n_docs").to_pylist() for r in rows] == [[600], [5]]
    run, found = alignment.members(rows[0].column("docs"))
    assert found.tolist() == list(range(600)) and set(run.tolist()) == {0}


def test_bitmaps_come_back(rng):
    for _ in range(20):
        sets = [sorted(rng.sample(range(alignment.BLOCK_DOCS), rng.choice([1, 3, 255, 256, 257, 2000]))) for _ in range(6)]
        run, places = np.repeat(np.arange(6), [len(s) for s in sets]), np.concatenate(sets)
        rows, found = alignment.members(alignment.bitmaps(run, places, 6))
        assert sorted(zip(rows.tolist(), found.tolist(), strict=True)) == sorted(zip(run.tolist(), places.tolist(), strict=True))


def word_pair():
    """A Thue-Morse word and its complement: equal under every polynomial with an odd base modulo 2**64."""
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_long_words_keep_apart_in_every_operator(spark, byte_level, tmp_path):
    one, other = word_pair()
    docs = spark.createDataFrame([(1, one), (2, other)], "doc_id long, text string")
    assert [r["component_id"] for r in near_dup.components(docs).orderBy("doc_id").collect()] == [1, 2]
    for cache in (bpe.codec(RANKS).cache, token_files.encoder(JSON).cache):
        ids, counts = cache.encode([one, other])
        assert [ids[:counts[0]].tolist(), ids[counts[0]:].tolist()] == [byte_level.encode(t).ids for t in (one, other)]
    assert len({r["ids_crc32"] for r in token_files.report(docs, JSON).collect()}) == 2
    items = spark.createDataFrame([("x", one)], "item_id string, text string")
    assert [r["contaminated"] for r in decontaminate.report(docs, items).orderBy("doc_id").collect()] == [True, False]


def test_colliding_hashes_change_no_ids(rng, monkeypatch, byte_level):
    whole = bytesets.span_hashes
    monkeypatch.setattr(bytesets, "span_hashes", lambda data, starts, ends, seed=0: whole(data, starts, ends, seed)
                        & np.uint64(0x3F if seed == piece_cache.KEY_SEED else 2**64 - 1))
    own, texts = token_files.LibraryEncoder(JSON), strange(rng, 300)
    for _ in range(2):
        ids, counts = own.cache.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [byte_level.encode(t, add_special_tokens=False).ids for t in texts]


def test_full_cache_keeps_what_was_met_again(rng, monkeypatch, byte_level):
    monkeypatch.setattr(piece_cache, "MAX_PIECES", 60)
    own = token_files.LibraryEncoder(JSON)
    for _ in range(8):
        texts = ["the same words"] + strange(rng, 10)
        ids, counts = own.cache.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [byte_level.encode(t, add_special_tokens=False).ids for t in texts]


def test_span_hashes_follow_the_bytes_alone(rng):
    data = np.frombuffer(bytes(rng.randrange(256) for _ in range(3000)), np.uint8)
    for size in (0, 1, 7, 8, 9, 127, 128, 129, 400):
        moved = np.concatenate((data[:11], data[500:500 + size], data[:5]))
        here, there = (bytesets.span_hashes(d, np.array([a]), np.array([a + size])) for d, a in ((data, 500), (moved, 11)))
        assert here == there and (size == 0 or here != bytesets.span_hashes(data, np.array([501]), np.array([501 + size])))
