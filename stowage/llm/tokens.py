"""Token ids of whole texts."""

from __future__ import annotations

import itertools
import os
import sys

import numpy as np

#: Words whose ids are remembered by one Python worker. Beyond it, those not met since the last time are forgotten.
REMEMBERED = 300_000
#: Stands after each text; no text in UTF-8 has this byte.
_END = b"\xff"
#: The characters by which byte-level models write the bytes that Latin-1 has no visible character for.
_VISIBLE = {b: 256 + k for k, b in enumerate(b for b in range(256) if b < 33 or 127 <= b < 161 or b == 173)}
_ALNUM = np.array([48 <= c <= 57 or 97 <= c <= 122 for c in range(256)])
#: What begins a word of its own after a letter or digit: any sign of ASCII but the apostrophe.
_SIGN = np.array([32 < c < 127 and not chr(c).isalnum() and c != 39 for c in range(256)])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _visible(word: bytes) -> str:
    return word.decode("latin-1").translate(_VISIBLE)


class _Memory:
    """Ids by word: those met of late, and those met before that."""

    def __init__(self):
        self.late, self.before = {}, {}

    def make_room(self, size: int) -> None:
        if len(self.late) > size:
            self.late, self.before = {}, self.late

    def recall(self, words) -> list[bytes]:
        """The words that are not known at all; the others are known of late from now on."""
        unknown = []
        for word in words:
            if (found := self.before.get(word)) is None:
                unknown.append(word)
            else:
                self.late[word] = found
        return unknown


class WordEncoder:
    """Ids by a tokenizer that lower-cases and drops white space, so that words can be encoded one by one.

    Holds for tokenizers whose splitting pattern never joins characters across ASCII white space, nor a letter or digit
    with a sign after it that is no apostrophe, and whose model is one of byte pairs. Ids of words are remembered across the
    tasks of a Python worker.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        # Kept on a module that outlives the task, since this class is sent anew with each.
        store = sys.modules["tokenizers"].__dict__.setdefault("_stowage_words", {})
        if path not in store:
            tokenizer = Tokenizer.from_file(path)
            added = [t.content.lower().encode() for t in tokenizer.get_added_tokens_decoder().values()]
            if not all(t.isascii() for t in added):
                raise ValueError("added tokens are looked for in ASCII only")
            model = tokenizer.model
            for word in ("word", "straße", "übergrößenträger", "cœur", "ÿ"):
                if [t.id for t in model.tokenize(_visible(word.encode()))] != tokenizer.encode(word, add_special_tokens=False).ids:
                    raise ValueError("the tokenizer's model is not one of words in bytes")
            store[path] = tokenizer, model, added, _Memory()
        self.tokenizer, self.model, self.added, self.memory = store[path]

    def _split(self, texts: list[bytes]) -> list[bytes]:
        """The words of lower-cased texts, with an end after each text; signs after letters begin a word."""
        joined = np.frombuffer(b"  " + b" \xff ".join([*texts, b""]), np.uint8)
        before = joined[1:-1]
        # Of the letters beyond ASCII these: A-grave to y-diaeresis, without the signs of multiplication and division.
        parts = _SIGN[joined[2:]] & (_ALNUM[before] | ((joined[:-2] == 0xC3) & (before != 0x97) & (before != 0xB7)))
        at = np.flatnonzero(parts) + 2
        spaced = np.full(len(joined) + len(at), 32, np.uint8)
        kept = np.ones(len(spaced), bool)
        kept[at + np.arange(len(at))] = False
        spaced[kept] = joined
        return spaced.tobytes().split()

    def _learn(self, words: list[bytes]) -> None:
        """Remember the ids of new words.

        Of Latin words in lower case nothing is to be normalised or split, so that the model is asked for them directly.
        """
        known, plain, shown, other = self.memory.late, [], [], []
        for word in words:
            text = word.decode()
            if word.isalpha():  # in ASCII
                plain.append(word)
                shown.append(text)
            elif text.isalpha() and (max(text) < "Ā" or text.islower() and max(text) < "ɐ"):
                plain.append(word)
                shown.append(_visible(text.lower().encode()))
            else:
                other.append(word)
        tokenize = self.model.tokenize
        found = [[t.id for t in tokenize(text)] for text in shown]
        data = np.fromiter(itertools.chain.from_iterable(found), "<u4").tobytes()
        cuts = (4 * np.cumsum([0, *map(len, found)])).tolist()
        known.update(zip(plain, map(data.__getitem__, map(slice, cuts[:-1], cuts[1:]))))
        for word, found in zip(other, self.tokenizer.encode_batch_fast([w.decode() for w in other], add_special_tokens=False)):
            known[word] = np.array(found.ids, "<u4").tobytes()

    def encode(self, texts: list[str | None], end: int | None = None) -> list[np.ndarray]:
        """Little-endian unsigned 32-bit ids of each text, with ``end`` after them."""
        last = b"" if end is None else np.array([end], "<u4").tobytes()
        encoded = []
        for start in range(0, len(texts), 256):
            self.memory.make_room(REMEMBERED)
            known = self.memory.late
            # Only A-Z change case and only ASCII white space parts words here, whatever else the tokenizer does with other characters.
            lowered = [(t or "").encode().lower() for t in texts[start:start + 256]]
            whole = {n for n, t in enumerate(lowered) if any(a in t for a in self.added)}
            words = self._split([b"" if n in whole else t for n, t in enumerate(lowered)])
            known[_END] = last
            found = list(map(known.get, words))
            gaps = [k for k, ids in enumerate(found) if ids is None]
            self._learn(self.memory.recall({words[k] for k in gaps}))
            for k in gaps:
                found[k] = known[words[k]]
            at = 0
            for n in range(len(lowered)):
                stop = words.index(_END, at) + 1
                own = b"".join(found[at:stop])
                if n in whole:  # a text with an added token's string, in whatever case
                    ids = self.tokenizer.encode(texts[start + n], add_special_tokens=False).ids
                    own = np.array(ids, "<u4").tobytes() + last
                encoded.append(np.frombuffer(own, "<u4"))
                at = stop
        return encoded
