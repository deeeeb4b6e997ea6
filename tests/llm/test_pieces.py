"""The encoder of op 7 over columns, against the library."""

import random

import pyarrow as pa
import pytest
from polycat.llm import sstable
from polycat.llm.queries import tokenizer_path


@pytest.mark.parametrize("chunk, kept", [(4 << 20, 10_000), (50, 30)])
def test_columns(monkeypatch, chunk, kept):
    """Odd white space, contractions, other scripts and special tokens, also where few bytes are taken at once, pieces are forgotten or the column is a slice; only distinct pieces become Python's."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(sstable, "CHUNK", chunk)
    monkeypatch.setattr(sstable, "KEPT", kept)
    r = random.Random(1)
    signs = [*"abAßñ'\"s t  re\n\t\r.,;-(019²½$€—“”… 　 \u0085­漢字カЖ٣🙂́‍_<|>", "'s", "'ll", " 've", "''s", "<|endoftext|>", "  ", "\n\n"]
    texts = ["".join(r.choices(signs, k=r.randint(0, 40))) for _ in range(1500)] + [None, "", " ", "\n", "x'", "a.b's,"]
    plain = Tokenizer.from_file(tokenizer_path())
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    enc = sstable.Encoder(tokenizer_path())
    for column in (pa.array(texts, pa.string()), pa.array(["before", *texts, "after"], pa.large_string()).slice(1, len(texts))):
        assert [x.tolist() for x in enc.encode(column)] == want
    seen = []
    monkeypatch.setattr(enc, "_keep", lambda new, keep=enc._keep: (seen.extend(new), keep(new)))
    enc._forget()
    list(enc.encode(pa.array(["so on so on, and so on"] * 3, pa.string())))
    assert len(seen) == len(set(seen)) or chunk == 50
    assert list(enc.encode(pa.array([], pa.string()))) == []
