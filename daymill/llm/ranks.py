"""Byte-level BPE by merge ranks: the ids of a tokenizer file of the tokenizers library, several times as fast."""

import json
import re

import numpy as np
import public_tokenizers

from daymill.llm.chunks import load

# Blocks whose letters, digits and white space all versions of Unicode agree on. Other texts go through the library.
SETTLED = re.compile("[^\x00-ɏ‐-‧‰-⁞]")
# A run without a boundary of words costs the rank form more than its length.
LONG_RUN = re.compile(r"\S{1000}|\s{1000}")


def byte_of_character() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest, in order,
    for those from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class RankEncoder:
    """Ids of whole texts as the tokenizers library gives them for a byte-level BPE file, without begin, end or added
    special tokens.

    Where the file is a plain byte-level BPE whose ids are the order of its merges, texts of settled characters without
    special strings and very long runs are encoded by rank; all other texts, and all texts of other files, by the library.
    """

    def __init__(self, path: str):
        import tiktoken

        self.library, self.ranks = load(path), None
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, before = file["model"], file["pre_tokenizer"] or {}
        self.special = [t["content"] for t in file["added_tokens"]]
        usual = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        odd = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")]
        if model["type"] != "BPE" or not usual or file["normalizer"] or any(odd):
            return
        of, vocabulary = byte_of_character(), model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [vocabulary.get(a + b) for a, b in pairs]
        plain = {t: i for t, i in vocabulary.items() if t not in self.special}
        if merged == list(range(256, 256 + len(pairs))) and len(plain) == 256 + len(pairs):
            ranks = {bytes(of[c] for c in token): i for token, i in plain.items()}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _settled(self, text: str) -> bool:
        if any(s in text for s in self.special) or (not text.isascii() and SETTLED.search(text)):
            return False
        return len(text) < 1000 or LONG_RUN.search(text) is None

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of a text; a null text is empty."""
        if not text:
            return np.zeros(0, np.uint32)
        if self.ranks is not None and self._settled(text):
            return np.asarray(self.ranks.encode_to_numpy(text, disallowed_special=()), np.uint32)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
