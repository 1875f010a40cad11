"""Token ids of texts by a word tokenizer file, each distinct word encoded once per task.

The tokenizer's normalizer and pattern never join what white space parts, so a text's ids
are those of its words, one after the other. An encoder remembers the words it met in two
generations of at most ``REMEMBER`` words: when the young one is full it becomes the old
one, and words met again come back from there. It lives as long as its task.

Where the file has the pipeline ``LATIN_PIPELINE``, a word of Latin letters (below U+0250)
with ASCII punctuation behind needs no normalizer and no pattern: the pattern parts its letters
from its punctuation, NFC leaves both as they are, and letters turn to lower case one by one. The library's model then gets the distinct runs of letters and of
punctuation; all other words go through the library's whole pipeline.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator

REMEMBER = 500_000
PIECE = 4 << 20  # bytes of a long text looked at together
#: The pipeline under which Latin words may be cut; fixed values.
LATIN_PIPELINE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: Letters below U+0250 but U+0130, whose lower case is no single letter; fixed values.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-įı-ɏ"
_LATIN = re.compile(rf"([{_LETTERS}]+)([!-/:-@\[-`{{-~]*)")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class WordEncoder:
    """Encodes texts with the tokenizer of a JSON text. ``spelled``: a special token in a text
    is spelled out; otherwise it has its own id."""

    def __init__(self, json_text: str, spelled: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.whole = Tokenizer.from_str(json_text)
        self.whole.encode_special_tokens = spelled
        parsed = json.loads(json_text)
        self.latin = all(parsed.get(k) == v for k, v in LATIN_PIPELINE.items()) and parsed["model"]["type"] == "BPE"
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.runs: dict[str, bytes] = {}
        if self.latin:
            level = ByteLevel(add_prefix_space=False, use_regex=False)
            low = {c.lower() for c in map(chr, range(0x250)) if _LATIN.fullmatch(c)} | set(map(chr, range(33, 127)))
            self.bytes_as = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in low})

    def _run(self, run: str) -> bytes:
        ids = self.runs.get(run)
        if ids is None:
            tokens = self.model.tokenize(run.translate(self.bytes_as))
            ids = self.runs[run] = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        return ids

    def _learn(self, words: set[bytes]) -> None:
        """Puts every word into the young generation."""
        if len(self.young) > REMEMBER:
            self.old, self.young = self.young, {}
        if len(self.runs) > REMEMBER:
            self.runs = {}
        young, old, rest = self.young, self.old, []
        self.model = self.whole.model
        for w in words.difference(young):
            ids = old.get(w)
            if ids is None and self.latin and (m := _LATIN.fullmatch(w.decode())):
                ids = self._run(m[1].lower()) + (self._run(m[2]) if m[2] else b"")
            if ids is None:
                rest.append(w)
            else:
                young[w] = ids
        for w, e in zip(rest, self.whole.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False), strict=True):
            young[w] = struct.pack(f"<{len(e.ids)}I", *e.ids)

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        split = [t.split() for t in texts]
        self._learn(set().union(*split))
        for words in split:
            yield b"".join(map(self.young.__getitem__, words))

    def encode_long(self, text: bytes) -> bytes:
        """``encode`` of one text, by pieces cut before white space."""
        out, a = [], 0
        while a < len(text):
            found = _SPACE.search(text, a + PIECE)
            b = found.start() if found else len(text)
            out += self.encode([text[a:b]])
            a = b
        return b"".join(out)
