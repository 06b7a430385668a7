import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyarrow import fs as pafs
from tokenizers import Tokenizer

from almacen.llm import byte_bpe, token_files

WORD = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    "Hello  world,\n it's 12 o'clock\t\tnow!!  ", "", None, " ", "ÀÉ é ́x ñandú Straße ΣΑΣ x\x85y\x1cz", "a" * 5000,
    "日本語 テキスト 🙂🙂 ok", "<|endoftext|> x <|startoftext|>", "Hello <|endoftext|> world", "a<|ENDOFTEXT|>b<|endoftext|>c <| endoftext|>", "same", "same", "word " * 3000, "\r\n\r\n  \n", "x" + " " * 2000 + "y",
]


def stream(spark, docs, **kw):
    return token_files.write_shards(docs, WORD, **kw)


def reference(rows):
    tok = Tokenizer.from_file(WORD)  # as it comes: added tokens in a text are found
    out, at = [], 0
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return out


def test_token_files(spark, make_docs):
    rows = [*enumerate(TEXTS), (3, " "), (None, "null id")]
    manifest = stream(spark, make_docs(rows, extra=True), seq_len=64, batch_rows=4)
    got = sorted(map(tuple, token_files.read_documents(manifest).collect()), key=lambda r: r[1])
    want = reference(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert got == [w[:4] for w in want]
    ids = sum((w[4] for w in want), [])
    seen = []
    for m in manifest.orderBy("shard").collect():
        f = token_files.TokenFile(pafs.LocalFileSystem(), m["tokens_path"])
        n, whole = 0, []
        for row in range(-(-m["n_tokens"] // 64)):
            x, mask = f.sequence(row)
            assert len(x) == len(mask) == 64
            whole += x[mask].tolist()
            n += int(mask.sum())
        assert n == m["n_tokens"]
        assert f.read(5, min(300, n)).tolist() == whole[5 : min(300, n)]
        view = f.sequence(0)[0]
        assert not view.flags.owndata  # a view of the file
        assert pa.ipc.open_stream(m["tokens_path"]).schema.field("ids").type == pa.list_(pa.uint16(), 64)
        seen += whole
    assert seen == ids


def test_words_by_parts_equal_whole_texts():
    rnd = random.Random(8)
    tok = Tokenizer.from_file(WORD)  # as it comes: added tokens in a text are found
    alphabet = "abAB'sé\u0301ÉΣσİıſŁ漢1²½.,;:!?-_ \n\t\x1c\x85\u3000🙂ﬁ"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(3000)]
    got = token_files.encode_texts(texts, WORD, np.dtype("<u2"))
    for t, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_token_files_empty(spark, make_docs):
    assert token_files.read_documents(stream(spark, make_docs([]))).count() == 0


def encoding():
    ranks, _ = byte_bpe.vocabulary(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(32_768, 512), (40, 12)])
def test_byte_bpe(spark, make_docs, chunk, overlap):
    rnd = random.Random(3)
    wild = ["".join(rnd.choice("ab 'stre\n\t 1é。!") for _ in range(rnd.randrange(400))) for _ in range(60)]
    rows = [*enumerate(TEXTS + wild), (4, TEXTS[4]), (0, "another text of a repeated id " * 9), (None, "x y " * 90)]
    df = byte_bpe.encode(make_docs(rows, extra=True), RANKS, public_tokenizers.PATTERN, chunk, overlap)
    got = byte_bpe.decode(df, RANKS).collect()
    enc, key = encoding(), lambda r: (r[0] is not None, r[0] or 0, r[2])
    mine = sorted(((r[0], np.frombuffer(r[1], "<u4").tolist(), bytes(r[2])) for r in got), key=key)
    want = sorted(((i, enc.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=key)
    assert mine == want


def test_byte_bpe_empty(spark, make_docs):
    assert byte_bpe.encode(make_docs([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_merge_long_piece():
    ranks, _ = byte_bpe.vocabulary(RANKS)
    enc = encoding()
    for piece in ("a" * 900, "abcab" * 150, "éé" * 200, "hthe" * 99):
        assert byte_bpe.merge(piece.encode(), ranks) == enc.encode_ordinary(piece)


def test_boundaries_leave_out_open_matches():
    pat = regex.compile(public_tokenizers.PATTERN)
    assert byte_bpe.boundaries("ab cd", pat, last=False) == [0]
    assert byte_bpe.boundaries("ab cd", pat, last=True) == [0, 2]
