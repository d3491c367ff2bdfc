import random
import zlib

import numpy as np
from hypothesis import example, given, settings, strategies as st
from tokenizers import Tokenizer

from helpers import STRANGE, documents
from stowage.llm import packing
from stowage.llm.tokens import WordEncoder, default_tokenizer


def plain_first_fit(sizes, capacity):
    free, out = [], []
    for size in sizes:
        at = next((k for k, f in enumerate(free) if f >= size), None)
        if at is None:
            at = len(free)
            free.append(capacity)
        out.append((at, capacity - free[at]))
        free[at] -= size
    return out


def test_tournament_is_first_fit():
    draw = random.Random(1)
    for _ in range(50):
        sizes = sorted((draw.randint(1, 100) for _ in range(draw.randint(1, 200))), reverse=True)
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        assert list(zip(bins, offsets)) == plain_first_fit(sizes, 100)
    assert packing.first_fit_decreasing([], 10) == ([], [])


def test_words_encode_like_whole_texts():
    whole = Tokenizer.from_file(default_tokenizer())
    texts = [t for _, t in STRANGE if t] + ["Don't. it's,'tis ##,x 1,2.3 É.é,<|endoftext|>. á, İstanbul ΣΑΣ.", "...,,.a", " x y"]
    texts.append("".join(map(chr, range(32, 1500))))
    texts += [a + chr(k) + b for k in range(33, 0x250) for a, b in (("x", "y"), ("é", "'s"), ("9", ""), ("", "ß"))]
    for text, ids in zip(texts, WordEncoder(default_tokenizer()).encode(texts)):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


WHOLE, BY_WORDS = Tokenizer.from_file(default_tokenizer()), WordEncoder(default_tokenizer())
CONTROLS = [chr(k) for k in range(33)] + ["\x7f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000", "\u200b", "\ufeff"]
MARKS = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|STARTOFTEXT|>", "<|", "|>", "endoftext"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from([*CONTROLS, *MARKS, "a", "B", "word", "É", "ß", "×", "7", ".", ",", "'s", "'", "!", "$$$", "(", "_", "-"]), max_size=12).map("".join))
@example("a\x1cb")
@example("a\x1f")
@example("\x1d \x1e")
@example("<|ENDOFTEXT|>")
@example("x<|endoftext|>\x1cY")
@example("a.")
@example("É,")
@example("÷. ÿ.")
def test_control_characters_and_marks_encode_like_whole_texts(text):
    assert BY_WORDS.encode([text])[0].tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_pack(spark):
    docs = documents(spark, STRANGE)
    rows = packing.pack(docs, group_bytes=20_000).collect()
    whole = Tokenizer.from_file(default_tokenizer())
    expected = sorted([*(whole.encode(t, add_special_tokens=False).ids if t else []), 1] for _, t in STRANGE)
    pieces = {}
    for r in rows:
        assert r.length == len(r.ids) // 4 <= 2048 and 0 <= r.offset and r.offset + r.length <= 2048
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    found = []
    for (key, total), parts in pieces.items():
        copies = sum(start == 0 for start, _ in parts)
        for copy in range(copies):  # rows with equal keys and lengths in these data are equal
            ids = b"".join(sorted(parts)[k * copies + copy][1] for k in range(len(parts) // copies))
            assert len(ids) == 4 * total
            found.append(np.frombuffer(ids, "<u4").tolist())
    assert sorted(found) == expected
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:])) and min(parts)[0] == 0


def test_empty_table(spark):
    assert packing.pack(documents(spark, [])).collect() == []


def test_padding_and_checksums(spark, sf_dir):
    from stowage.llm.queries import op1_packing

    rows = op1_packing(spark, sf_dir).collect()
    tokens, sequences = sum(r.length for r in rows), len({r.sequence_id for r in rows})
    assert tokens > 0.95 * 2048 * (sequences - 1)
    whole = Tokenizer.from_file(default_tokenizer())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in rows:
        ids = [*whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        part = np.array(ids[r.start:r.start + r.length], "<u4")
        assert (len(ids), len(part), zlib.crc32(part.tobytes())) == (r.doc_tokens, r.length, r.ids_crc32)
