"""SentencePiece encoding with seeded merge-dropout, and decoding."""

import heapq
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from daymill.llm.chunks import ragged
from daymill.llm.common import BATCH_BYTES, bound_batches, free_name, gathered, lean

DROPOUT = 0.1
SHARED = 32  # characters of chunks whose segmentations are shared by occurrences; longer ones are segmented one by one, alike
ROWS = 1 << 14  # of them, or of occurrences, at once
TOKENS = 1 << 17  # decoded at once, or those of one text
SENT = 250  # rows of a batch that is handed on

CHUNK = re.compile(" +[^ ]*")
MASK = (1 << 64) - 1
FIRST, SECOND, THIRD = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9  # odd factors of the keyed hash
SLOTS = 20  # bits of the pair table
NONE, NEVER = np.int32(-1), np.int32(2**31 - 1)
_held: dict[str, "Pieces"] = {}
_plain: dict[str, "Pieces"] = {}


class Pieces:
    """The merge-type vocabulary of a model file, with the blank as itself instead of its visible mark.

    A mark that a text holds itself is then an unknown character and goes to bytes, so decoding gives it back.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) for i in range(size)]
        self.bytes_of: list[bytes] = []
        self.id_of: dict[str, int] = {}
        self.priority = [-model.get_score(i) for i in range(size)]
        self.byte_id = [0] * 256
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.bytes_of.append(bytes([value]))
            elif special[i]:
                self.bytes_of.append(b"")
            else:
                piece = piece.replace("\u2581", " ")
                self.id_of[piece] = i
                self.bytes_of.append(piece.encode())
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.byte_counts = np.fromiter(map(len, self.bytes_of), np.int64, size)
        self.byte_starts = np.cumsum(self.byte_counts) - self.byte_counts

    @classmethod
    def of(cls, path: str) -> "Pieces":
        """Made once in each worker."""
        if path not in _held:
            _held[path] = cls(path)
            _held[path]._make_pairs()
        return _held[path]

    @classmethod
    def for_decoding(cls, path: str) -> "Pieces":
        """Without the tables that only encoding needs."""
        if path not in _held and path not in _plain:
            _plain[path] = cls(path)
        return _held.get(path) or _plain[path]

    def _make_pairs(self) -> None:
        """A hash table from pairs of pieces to the piece they make, the order of pieces, and the ids of single characters."""
        size = len(self.bytes_of)
        self.size = np.int64(size)
        self.order = np.argsort(np.argsort(self.priority, kind="stable"), kind="stable").astype(np.int32)
        self.slot_key = np.full(1 << SLOTS, -1, np.int64)
        self.slot_piece = np.full(1 << SLOTS, NONE, np.int32)
        self.probes = 1
        for piece, number in self.id_of.items():
            for cut in range(1, len(piece)):
                a, b = self.id_of.get(piece[:cut]), self.id_of.get(piece[cut:])
                if a is not None and b is not None:
                    key = a * size + b
                    at, probes = ((key * FIRST) & MASK) >> (64 - SLOTS), 1
                    while self.slot_key[at] >= 0:
                        at, probes = (at + 1) % (1 << SLOTS), probes + 1
                    self.slot_key[at], self.slot_piece[at] = key, number
                    self.probes = max(self.probes, probes)
        self.single = {ord(p): i for p, i in self.id_of.items() if len(p) == 1}

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ids: their bytes one after the other, without the first blank. Few runs at a time, as each
        byte takes some numbers meanwhile."""
        ends, out, first = np.concatenate([[0], np.cumsum(counts)]), [], 0
        while first < len(counts):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + TOKENS, "right")) - 1)
            out.extend(self._texts(ids[ends[first] : ends[last]], counts[first:last]))
            first = last
        return out

    def _texts(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        n = self.byte_counts[ids]
        data = self.all_bytes[ragged(self.byte_starts[ids], n)].tobytes()
        ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [data[a + 1 : b].decode() for a, b in zip(ends, ends[1:])]

    def encode_all(self, chunks: list[str], keys: list[int], skip_below: int) -> list[bytes]:
        """`encode` of each chunk with its key, as bytes of 32-bit ids."""
        number: dict[str, int] = {}
        codes = np.array([number.setdefault(c, len(number)) for c in chunks], np.int64)
        parts, at = self.encode_occurrences(list(number), codes, np.array(keys, np.uint64), skip_below)
        return [parts[i] for i in at.tolist()]

    def encode_occurrences(self, chunks: list[str], codes: np.ndarray, keys: np.ndarray, skip_below: int) -> tuple[list[bytes], np.ndarray]:
        """`encode` of chunks[code] with its key for each (code, key): segmentations as bytes of 32-bit ids, and the
        number of the one of each occurrence.

        Which pairs an occurrence skips is up to its key alone, but equal skips give equal ids. All occurrences of a
        chunk start from its segmentation without skips. Those that skip none of its merges have it; the others go on
        from the first merge they skip to the segmentation that skips this one too, until they skip none. One that is
        alone is segmented by its key at once.
        """
        parts: list[bytes] = []
        at = np.empty(len(codes), np.int64)
        long = np.fromiter((len(c) > SHARED for c in chunks), bool, len(chunks))
        going = np.arange(len(codes))
        if long.any():
            seen: dict[tuple, int] = {}
            for i in np.flatnonzero(long[codes]).tolist():
                key = int(keys[i]) if skip_below else 0
                if (codes[i], key) not in seen:
                    seen[codes[i], key] = len(parts)
                    parts.append(np.array(self.encode(chunks[codes[i]], key, skip_below), "<i4").tobytes())
                at[i] = seen[codes[i], key]
            going = np.flatnonzero(~long[codes])
        # Groups of occurrences with the same chunk and skips.
        group, skips = codes[going], np.zeros((len(chunks), 0), np.int64)
        chunk_of = np.arange(len(chunks))
        while len(going):
            present, inverse, sizes = np.unique(group, return_inverse=True, return_counts=True)
            chunk_of, skips = chunk_of[present], skips[present]
            alone = (sizes == 1) & (skip_below > 0)
            if alone.any():
                mine = alone[inverse]
                one = np.flatnonzero(mine)
                ids, _, _ = self._passes([chunks[codes[i]] for i in going[one].tolist()], keys[going[one]], skip_below, np.zeros((len(one), 0), np.int64))
                at[going[one]] = len(parts) + np.arange(len(one))
                parts.extend(ids)
                renumbered = np.cumsum(~alone) - 1
                going, inverse = going[~mine], renumbered[inverse[~mine]]
                chunk_of, skips = chunk_of[~alone], skips[~alone]
            ids, merges, counts = self._passes([chunks[c] for c in chunk_of.tolist()], np.zeros(len(chunk_of), np.uint64), 0, skips)
            at[going] = len(parts) + inverse
            parts.extend(ids)
            if not skip_below:
                break
            starts = np.cumsum(counts) - counts
            tests = ((merges >> 32).astype(np.uint64) * np.uint64(FIRST)) ^ ((merges & 0xFFFFFFFF).astype(np.uint64) * np.uint64(SECOND))
            owners, firsts = [], []
            for first in range(0, len(going), ROWS):
                # All merges of some occurrences, one after the other.
                of = inverse[first : first + ROWS]
                n = counts[of]
                mixed = tests[ragged(starts[of], n)] ^ np.repeat(keys[going[first : first + ROWS]], n)
                mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(THIRD)
                hits = np.flatnonzero((mixed ^ (mixed >> np.uint64(29))) < np.uint64(skip_below))
                owner, earliest = np.unique(np.repeat(np.arange(len(of)), n)[hits], return_index=True)
                owners.append(owner + first)
                firsts.append(starts[of[owner]] + hits[earliest] - (np.cumsum(n) - n)[owner])
            owners, firsts = np.concatenate([going[:0], *owners]), np.concatenate([going[:0], *firsts])
            # The merge that is skipped, by its number among all merges of all groups, names the next group.
            by_merge = np.repeat(np.arange(len(counts)), counts)
            going, group = going[owners], firsts
            chunk_of, skips = chunk_of[by_merge], np.concatenate([skips[by_merge], merges[:, None]], 1)
        return parts, at

    def _pairs(self, a, b, left, keys, skip_below: int, skips: np.ndarray) -> np.ndarray:
        """The piece of each pair that may be merged, else NONE: those of `skips` (place and piece, by row) may not."""
        key = a.astype(np.int64) * self.size + b
        at = ((key.astype(np.uint64) * np.uint64(FIRST)) >> np.uint64(64 - SLOTS)).astype(np.int64)
        found = np.full(len(key), NONE, np.int32)
        for _ in range(self.probes):
            hit = self.slot_key[at] == key
            found[hit] = self.slot_piece[at[hit]]
            at = (at + 1) % (1 << SLOTS)
        found[(a < 0) | (b < 0)] = NONE
        if skip_below:
            mixed = keys ^ (left.astype(np.uint64) * np.uint64(FIRST)) ^ (found.astype(np.uint64) * np.uint64(SECOND))
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(THIRD)
            found[(mixed ^ (mixed >> np.uint64(29))) < np.uint64(skip_below)] = NONE
        for skip in skips.T:
            found[(left.astype(np.int64) << 32 | found) == skip] = NONE
        return found

    def _passes(self, chunks: list[str], keys: np.ndarray, skip_below: int, skips: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Of each chunk with its key and its row of `skips`: the ids as bytes, and its merges (place << 32 | piece), row
        by row, with the number of a row. Chunks of similar length go side by side: the agenda's best pair of every
        chunk is merged at once. Whether a pair is skipped depends on row, place and piece only, so the order of the
        agendas is kept."""
        out: list[bytes] = [b""] * len(chunks)
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order, merged = np.argsort(lengths, kind="stable"), []
        for first in range(0, len(order), ROWS):
            rows = order[first : first + ROWS]
            merged.extend(self._side_by_side(rows, [chunks[i] for i in rows.tolist()], keys[rows], skip_below, skips[rows], out))
        owner = np.concatenate([np.zeros(0, np.int64), *[m[0] for m in merged]])
        merges = np.concatenate([np.zeros(0, np.int64), *[m[1] for m in merged]])
        return out, merges[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(chunks))

    def _side_by_side(self, rows: np.ndarray, chunks: list[str], keys: np.ndarray, skip_below: int, skips: np.ndarray, out: list[bytes]) -> list[tuple]:
        width = max(map(len, chunks))
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        distinct, inverse = np.unique(codes, return_inverse=True)
        # Characters outside the vocabulary are negative, and merge with nothing.
        ids = np.array([self.single.get(c, -2 - c) for c in distinct.tolist()], np.int32)
        symbols = np.full((len(chunks), width + 1), NONE, np.int32)
        symbols[np.arange(width + 1) < lengths[:, None]] = ids[inverse]
        place = np.tile(np.arange(width + 1, dtype=np.int32), (len(chunks), 1))
        flat = self._pairs(symbols[:, :-1].ravel(), symbols[:, 1:].ravel(), place[:, :-1].ravel(), np.repeat(keys, width), skip_below, np.repeat(skips, width, 0))
        found = np.concatenate([flat.reshape(len(chunks), width), np.full((len(chunks), 1), NONE, np.int32)], 1)
        index, merged = rows, []
        columns = np.arange(width + 1)
        while len(index):
            rank = np.where(found >= 0, self.order[found], NEVER)
            best = rank.argmin(1)
            line = np.arange(len(index))
            going = rank[line, best] < NEVER
            if not going.all():
                self._finish(index[~going], symbols[~going], out)
                index, symbols, place, found, keys, skips, best = (x[going] for x in (index, symbols, place, found, keys, skips, best))
                line = np.arange(len(index))
                if not len(index):
                    break
            symbols[line, best] = found[line, best]
            merged.append((index, place[line, best].astype(np.int64) << 32 | found[line, best]))
            # The part behind the merged one moves up.
            source = np.minimum(columns + (columns > best[:, None]), columns[-1])
            symbols, place, found = (np.take_along_axis(x, source, 1) for x in (symbols, place, found))
            symbols[:, -1], found[:, -1] = NONE, NONE
            for at in (best, best - 1):
                some = at >= 0
                r, c = line[some], at[some]
                found[r, c] = self._pairs(symbols[r, c], symbols[r, np.minimum(c + 1, columns[-1])], place[r, c], keys[some], skip_below, skips[some])
        return merged

    def _finish(self, index: np.ndarray, symbols: np.ndarray, out: list[bytes]) -> None:
        plain = (symbols >= NONE).all(1)
        counts = (symbols >= 0).sum(1)
        data = symbols[plain][symbols[plain] >= 0].astype("<i4").tobytes()
        end = 0
        for i, n in zip(index[plain].tolist(), counts[plain].tolist()):
            out[i] = data[end : end + 4 * n]
            end += 4 * n
        for i, row in zip(index[~plain].tolist(), symbols[~plain].tolist()):
            ids = []
            for x in row:
                ids.extend([x] if x >= 0 else () if x == -1 else [self.byte_id[b] for b in chr(-2 - x).encode("utf-8", "replace")])
            out[i] = np.array(ids, "<i4").tobytes()

    def encode(self, chunk: str, key: int, skip_below: int, merges: list | None = None) -> list[int]:
        """Ids of a chunk. The agenda gives the best pair first, the left one of equals. A pair is skipped when the hash
        of the key, its place and its piece is below the bound; a skipped pair comes back only as part of other pairs. Pairs that are merged are added to `merges`, in order."""
        parts: list[str | None] = list(chunk)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        id_of, priority = self.id_of, self.priority
        agenda = []
        for i in range(n - 1):
            found = id_of.get(parts[i] + parts[i + 1])
            if found is not None:
                agenda.append((priority[found], i, i + 1, len(parts[i]) + len(parts[i + 1]), found))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size, found = heapq.heappop(agenda)
            a, b = parts[left], parts[right]
            if a is None or b is None or after[left] != right or len(a) + len(b) != size:
                continue
            if skip_below:
                mixed = (key ^ (left * FIRST) ^ (found * SECOND)) & MASK
                mixed = ((mixed ^ (mixed >> 31)) * THIRD) & MASK
                if (mixed ^ (mixed >> 29)) < skip_below:
                    continue
            if merges is not None:
                merges.append((left, found))
            parts[left], parts[right] = a + b, None
            nxt = after[left] = after[right]
            if nxt < n:
                before[nxt] = left
                joined = id_of.get(parts[left] + parts[nxt])
                if joined is not None:
                    heapq.heappush(agenda, (priority[joined], left, nxt, size + len(parts[nxt]), joined))
            prev = before[left]
            if prev >= 0:
                joined = id_of.get(parts[prev] + parts[left])
                if joined is not None:
                    heapq.heappush(agenda, (priority[joined], prev, left, size + len(parts[prev]), joined))
        ids = []
        for part in parts:
            if part is not None:
                found = id_of.get(part)
                if found is not None:
                    ids.append(found)
                else:
                    ids.extend(self.byte_id[b] for b in part.encode("utf-8", "replace"))
        return ids


def encode(docs: DataFrame, model_path: str, *, dropout: float = DROPOUT, seed: int = 0, id_col: str = "doc_id",
           text_col: str = "text", to: str = "ids", at_once: int = BATCH_BYTES) -> DataFrame:
    """`docs` with the ids of each whole text in column `to`.

    The model puts a blank before the text, and no piece holds a blank after another character, so texts fall into
    chunks of blanks and what follows them; each chunk is a segmentation of its own. Each occurrence of a chunk gets its own
    key by a hash of seed, document id, text and place, so the same input and seed give the same ids in
    any order and number of tasks, and copies with other ids other segmentations. Occurrences that skip the same merges
    share a segmentation; about `at_once` bytes of texts are in memory, whatever their ids. With dropout 0 the ids are those of the library. Null and empty texts have no ids; rows may repeat; a column named as `to` is replaced.
    """
    bound_batches(docs.sparkSession, at_once)
    docs = docs.drop(to)
    key_col = free_name(docs, "__segment_key")
    key = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    schema = StructType([*docs.schema.fields, StructField(to, ArrayType(IntegerType()))])
    skip_below, kept = min(int(dropout * MASK), MASK), docs.columns

    def encoded(pieces, held):
        """A function of its own, so that what it holds is free before the next texts are gathered."""
        texts = held.column(text_col).to_pylist()
        marks = held.column(key_col).to_numpy().astype(np.uint64)
        number: dict[str, int] = {}
        codes, lengths = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                found = CHUNK.findall(" " + text)
                lengths[i] = len(found)
                codes.extend([number.setdefault(c, len(number)) for c in found])
        del texts
        codes = np.array(codes, np.int64)
        ends = np.cumsum(lengths)
        place = np.arange(len(codes), dtype=np.uint64) - np.repeat(ends - lengths, lengths).astype(np.uint64)
        mixed = (np.repeat(marks, lengths) + place * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        del place
        mixed ^= mixed >> np.uint64(32)
        parts, at = pieces.encode_occurrences(list(number), codes, mixed, skip_below)
        del number, codes, mixed
        counts = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), "<i4")
        del parts
        total = np.concatenate([[0], np.cumsum(counts[at])])
        ids = flat[ragged((np.cumsum(counts) - counts)[at], counts[at])]
        offsets = np.concatenate([[0], total[ends]]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
        columns = [held.column(c).combine_chunks() for c in kept]
        return pa.RecordBatch.from_arrays([*columns, lists], names=schema.names)

    def run(batches):
        pieces = Pieces.of(model_path)
        for held in gathered(batches, text_col, at_once * 3 // 4):
            whole = encoded(pieces, held)
            del held
            for first in range(0, len(whole), SENT):
                yield whole.slice(first, SENT)
            del whole

    return docs.withColumn(key_col, key).mapInArrow(lean(run), schema)


def decode(encoded: DataFrame, model_path: str, *, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """`encoded` with the text of the ids in column `to`: their bytes one after the other, without the first blank.
    No ids, or null, give the empty text; a column named as `to` is replaced."""
    bound_batches(encoded.sparkSession)
    encoded = encoded.drop(to)
    schema = StructType([*encoded.schema.fields, StructField(to, StringType())])

    def run(batches):
        pieces = Pieces.for_decoding(model_path)
        for batch in batches:
            lists = batch.column(ids_col)
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            texts = pieces.texts(lists.flatten().to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(lean(run), schema)
