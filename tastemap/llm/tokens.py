"""Token ids by the tokenizers library, with each word encoded once per worker."""

import json
import os
import re
from collections.abc import Iterable

import numpy as np
from tokenizers import Tokenizer

from tastemap.llm.shared import kept

# Words kept with their ids in a worker; further ones are encoded at every batch.
MEMO_WORDS = 800_000

# The normalizer and the splits of tokenizer files for which the ids of a
# text are those of its words in turn.
SPLIT_NORMALIZERS = [{"type": "NFC"},
                     {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
                     {"type": "Lowercase"}]
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# A word of Latin letters, then ASCII marks other than the apostrophe.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else the next past 255."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    table = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {b: table[b] for b in range(256)}


class Encoder:
    """Ids of whole texts as the bytes of little-endian unsigned 32-bit integers.

    Where the tokenizer file splits at white space (``words`` is true), no token
    spans a blank, and the ids of a text are those of its blank-separated words
    in turn: each distinct word is encoded once and kept, up to
    ``MEMO_WORDS``. For other tokenizers whole texts are encoded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        normal, split = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps = split.get("pretokenizers") or [{}]
        added = [t for t in spec.get("added_tokens", ())
                 if t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                 or re.search(r"\s", t["content"])]
        self.words = (normal.get("normalizers") == SPLIT_NORMALIZERS and not added
                      and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
                      and steps[0].get("pattern") == {"Regex": SPLIT_PATTERN}
                      and spec["model"]["type"] == "BPE")
        self.letters = _byte_letters()
        self.memo: dict[bytes, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _model(self, piece: str) -> bytes:
        letters = piece
        if not piece.isascii():
            letters = "".join(map(self.letters.__getitem__, piece.encode()))
        return np.array([t.id for t in self.tokenizer.model.tokenize(letters)], "<u4").tobytes()

    def _new_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are not in the memo, and of the lower-case letters in them, which are
        words too."""
        found, odd = {}, []
        for word in words:
            plain = PLAIN.fullmatch(word.decode())
            if plain is None:
                odd.append(word)
                continue
            piece, marks = plain.groups()
            piece = piece.lower()
            low = piece.encode()
            ids = self.memo.get(low) or found.get(low)
            if ids is None:
                ids = found[low] = self._model(piece)
            if marks:
                if marks not in self.marks and len(self.marks) < MEMO_WORDS:
                    self.marks[marks] = self._model(marks)
                ids += self.marks.get(marks) or self._model(marks)
            found[word] = ids
        texts = [w.decode() for w in odd]
        for word, encoding in zip(odd, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            found[word] = np.array(encoding.ids, "<u4").tobytes()
        return found

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of each UTF-8 text; a null one has none."""
        if not self.words:
            batch = self.tokenizer.encode_batch([(t or b"").decode() for t in texts],
                                                add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() for e in batch]
        # Splitting bytes cuts at ASCII blanks alone.
        split = [(t or b"").split() for t in texts]
        memo = self.memo
        new = self._new_words(set().union(*split).difference(memo))
        if len(memo) + len(new) <= MEMO_WORDS:
            memo.update(new)
            new = {}
        if not new:
            return [b"".join(map(memo.__getitem__, words)) for words in split]
        return [b"".join([memo[w] if w in memo else new[w] for w in words]) for words in split]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, kept from task to task."""
    return kept(("encoder", path), lambda: Encoder(path))
