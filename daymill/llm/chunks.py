"""Tokenizing by distinct chunks: a text's ids are those of its chunks, and most chunks recur."""

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A white-space character followed by a blank, by the widest notion of white space.
BLANK_AFTER_SPACE = r"[\t-\r\x1c-\x20\x{85}\pZ] "
# Lower-case letters of ASCII and Latin-1: normal forms and lower case leave them as they are.
SMALL = r"a-z\x{df}-\x{f6}\x{f8}-\x{ff}"
SMALL_WORD = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")

# Chunks that a worker has met and keeps for its next tasks, by tokenizer file. It saves time and decides nothing.
SEEN: dict[str, dict[str, bytes]] = {}
SEEN_CHUNKS = 200_000
# Chunks given to the library at once; its results are several times their size until their ids are taken out.
ENCODE_CHUNKS = 4096


def load(path: str):
    """A tokenizer of the tokenizers library, without truncation and padding, one thread."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


class ChunkEncoder:
    """Ids of whole texts. Texts are cut where no token can cross, each distinct chunk of a call goes through
    the tokenizer once, and its ids are put in place by numpy.

    blanks_lead=False: the tokenizer composes (NFC), lower-cases, drops white space and parts letters from marks,
    so texts are cut at white space and between a letter and a mark after it, and A-Z are lower-cased first (not
    where a special string could arise). Words of plain small letters skip normalizing, which leaves them alone.
    blanks_lead=True: a blank belongs to the chunk after it, as in byte-level pre-tokenizers, whose tokens never
    hold a blank after another character. A text with a blank after white space is encoded in one piece.
    """

    def __init__(self, path: str, blanks_lead: bool):
        from tokenizers import Tokenizer, pre_tokenizers

        self.path, self.tokenizer, self.blanks_lead = path, load(path), blanks_lead
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def _fresh(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks as bytes of 32-bit numbers."""
        def through(tokenizer, some):
            for i in range(0, len(some), ENCODE_CHUNKS):
                for e in tokenizer.encode_batch_fast(some[i : i + ENCODE_CHUNKS], add_special_tokens=False):
                    yield array("I", e.ids).tobytes()

        if self.blanks_lead:
            return list(through(self.tokenizer, chunks))
        easy = [SMALL_WORD.fullmatch(c) is not None for c in chunks]
        plain = through(self.plain, [c for c, e in zip(chunks, easy) if e])
        full = through(self.tokenizer, [c for c, e in zip(chunks, easy) if not e])
        return [next(plain if e else full) for e in easy]

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        seen = SEEN.setdefault(self.path, {})
        missing = [c for c in chunks if c not in seen]
        fresh = dict(zip(missing, self._fresh(missing)))
        ids = [seen[c] if c in seen else fresh[c] for c in chunks]
        for chunk, data in fresh.items():
            if len(seen) >= SEEN_CHUNKS:
                break
            if len(chunk) <= 40:
                seen[chunk] = data
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        return np.frombuffer(b"".join(ids), np.uint32), counts

    def _chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(chunks per text, number of each chunk, the distinct chunks)."""
        if not self.blanks_lead:
            lowered = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
            lists = pc.ascii_split_whitespace(pc.replace_substring_regex(lowered, rf"([{SMALL}])([.,;:!?])", r"\1 \2"))
            words = lists.flatten().dictionary_encode()
            return np.diff(lists.offsets.to_numpy()), words.indices.to_numpy(), words.dictionary.to_pylist()
        whole = pc.match_substring_regex(texts, BLANK_AFTER_SPACE)
        parts = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        words = parts.flatten().dictionary_encode()
        lengths = np.diff(parts.offsets.to_numpy())
        lead = np.ones(len(words), bool)
        lead[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
        distinct, codes = np.unique(words.indices.to_numpy().astype(np.int64) * 2 + lead, return_inverse=True)
        plain = words.dictionary.to_pylist()
        chunks = [" " * (k & 1) + plain[k >> 1] for k in distinct.tolist()]
        at = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if len(at):
            codes[(np.cumsum(lengths) - lengths)[at]] = len(chunks) + np.arange(len(at))
            chunks += texts.take(pa.array(at)).to_pylist()
        return lengths, codes, chunks

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text; a null text is empty."""
        return self._placed(texts)[0]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids one after the other)."""
        counts, codes, ids, per_chunk = self._placed(texts)
        starts = np.cumsum(per_chunk) - per_chunk
        return counts, ids[ragged(starts[codes], per_chunk[codes])]

    def _placed(self, texts: pa.Array):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts, "")
        lengths, codes, chunks = self._chunks(texts)
        ids, per_chunk = self._encode(chunks)
        total = np.concatenate([[0], np.cumsum(per_chunk[codes])])
        ends = np.cumsum(lengths)
        return total[ends] - total[ends - lengths], codes, ids, per_chunk
