import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from flowguard.llm import pieces, tokenfile
from flowguard.session import shared_dir
from tests.llm.helpers import edge_rows, frame

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    pools = ["ab c", "  ▁ a", "the of and \n\t.,", "éèñ́̈ e oÀŠİ", "\U0001F600漢字 か", "<s></s><unk><0x41>", "\x00\x01\x1c\x85\xa0  a",
             "Σσς ΑΣ ", "<|endoftext|> <|startoftext|>x", "'s 't don't I'LL 12", "​̀각 ", "aaaaaaaaaaa", "¼²ª×ß%$#&!~"]
    out = ["", " ", "  ", "a ", " a", "x" * 5000]
    for _ in range(n):
        pool = rng.choice(pools) + rng.choice(pools)
        if rng.random() < 0.3:
            out.append("".join(rng.choice(pool.split(" ") + [" "]) for _ in range(rng.randint(0, 8))))
        elif rng.random() < 0.2:
            out.append("".join(chr(rng.choice([rng.randint(0, 0x2FFF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(rng.randint(1, 10))))
        else:
            out.append("".join(rng.choice(pool) for _ in range(rng.randint(0, 24))))
    return out


def test_agenda_equals_the_library():
    book, values = pieces.MergeVocabulary(PIECES), odd_texts(4000)
    found = book.encode(values)
    decoded = book.decode_all(found)
    for value, ids, text in zip(values, found, decoded):
        theirs = book.lib.encode(value)
        assert np.frombuffer(ids, "<i4").tolist() == theirs and text.decode() == book.lib.decode(theirs), value


def test_both_agendas_agree():
    book = pieces.MergeVocabulary(PIECES)
    segments = [s for v in odd_texts(1500, 5) for s in book.segments(v)]
    ids, counts = book.encode_segments(segments)
    ends = np.cumsum(counts)
    for s, e, n in zip(segments, ends, counts):
        assert ids[e - n:e].tolist() == book.encode_segment(s)


def test_a_wrong_agenda_is_noticed():
    book = pieces.MergeVocabulary(PIECES)
    book.pair_cost = -book.pair_cost
    with pytest.raises(ValueError):
        book.encode(["some ordinary words of a sentence"])


def test_encoded_rows(spark):
    rows = edge_rows([(20 + i, t) for i, t in enumerate(odd_texts(200, 9))])
    lib = pieces.MergeVocabulary(PIECES).lib
    got = pieces.digests(pieces.encode_pieces(frame(spark, rows), PIECES)).collect()

    def want(i, t):
        ids = lib.encode(t or "")
        return (i or -1, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest())

    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want(r[0], r[1]) for r in rows)
    assert pieces.encode_pieces(frame(spark, []), PIECES).count() == 0


def test_word_encoder_equals_the_library():
    book, values = tokenfile.WordEncoder(WORDS, False), odd_texts(6000, 8)
    theirs = book.lib.encode_batch(values, add_special_tokens=False)
    assert book.encode(values) == [np.asarray(e.ids, "<u2").tobytes() for e in theirs]


def test_token_files(spark):
    rows = edge_rows([(20 + i, t) for i, t in enumerate(odd_texts(200, 9))])
    folder = shared_dir(spark, "token-test")
    tokenfile.write_tokens(frame(spark, rows).repartition(5), folder, WORDS, 2)
    lib = tokenfile.WordEncoder(WORDS, False).lib
    start, want = 0, []
    for i, t in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.asarray([*lib.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [(r.doc_id, r.start, zlib.crc32(r.ids)) for r in tokenfile.read_tokens(spark, folder).orderBy("start").collect()]
    assert got == want
    empty = shared_dir(spark, "token-test")
    tokenfile.write_tokens(frame(spark, []), empty, WORDS, 2)
    assert tokenfile.read_tokens(spark, empty).count() == 0


def test_merged_rows_hold_only_what_is_left():
    # Rows shrink as they merge; ids of all segments come back in one array, the odd ones in their place.
    book = pieces.MergeVocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    segments = [" the", " \U0001F642x", " " + "ab" * 40, " the", "  q", " internationalisation", " \U0001F642x"]
    ids, counts = book.encode_segments(segments)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [book.encode_segment(s) for s in segments]
    seen = []
    whole = book.pair
    book.pair = lambda left, right: (seen.append(len(right)), whole(left, right))[1]
    rows = np.asarray([[*book.char[[ord(c) for c in " the"]], -1, -1, -1, -1]])
    assert (book.merge_rows(rows) >= 0).sum() == len(book.encode_segment(" the"))
    left, right = np.asarray([5, 5]), np.asarray([-1, -1])
    made, cost = whole(left, right)
    assert made.tolist() == [0, 0] and np.isinf(cost).all()
