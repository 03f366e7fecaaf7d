"""SentencePiece encoding with byte spans of the source, and decoding.

Text is normalised by the longest prefix that the model's compiled character map knows,
and every normalised character keeps the place in the source where its prefix starts. Pieces
are merged by score; their ends, looked up in these places, are spans of the original bytes.
"""

from __future__ import annotations

import codecs
import heapq
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read, text_or_empty

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
# Stretches a task remembers, up to a length; how many are merged at once; characters of the
# texts that are encoded together; ids per output batch.
MOST_SEEN, LONGEST_ROW, ROWS = 150_000, 64, 20_000
CHARACTERS, IDS_PER_BATCH = 500_000, 250_000


class CharacterMap:
    """The compiled map: a double array of UTF-8 prefixes and the texts they turn into."""

    def __init__(self, compiled: bytes) -> None:
        size = int.from_bytes(compiled[:4], "little")
        self._units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self._texts = compiled[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """What the longest known prefix of data[at:] turns into, and its length."""
        units, found = self._units, None
        node = self._child(0)
        for end in range(at, len(data)):
            node ^= data[end]
            if node >= len(units) or units[node] & 0x800000FF != data[end]:
                break
            has_value = units[node] >> 8 & 1
            node ^= self._child(node)
            if has_value:
                found = units[node] & 0x7FFFFFFF, end + 1 - at
        if found is None:
            return None
        start, length = found
        return self._texts[start : self._texts.index(b"\0", start)], length

    def _child(self, node: int) -> int:
        unit = self._units[node]
        return unit >> 10 << ((unit & 1 << 9) >> 6)


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("each_byte", _each_byte)


class PieceModel:
    """A BPE model file. Models with user-defined or unused pieces, unescaped spaces, space
    suffixes or a denormaliser are refused."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, trained = model.normalizer_spec, model.trainer_spec
        odd = {p.type for p in model.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}
        if (
            trained.model_type != trained.BPE
            or odd
            or not spec.escape_whitespaces
            or trained.treat_whitespace_as_suffix
            or model.denormalizer_spec.precompiled_charsmap
        ):
            raise ValueError(f"{path} is no BPE model of plain pieces")
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        kinds = [p.type for p in model.pieces]
        texts = [p.piece for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.costs = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        self.unknown = kinds.index(UNKNOWN)
        byte_ids = {t: i for i, t in enumerate(texts) if kinds[i] == BYTE}
        self.bytes = [byte_ids[f"<0x{b:02X}>"] for b in range(256)] if byte_ids else None
        surfaces = {NORMAL: lambda t: t.replace(SPACE, " ").encode(), CONTROL: lambda t: b""}
        surfaces |= {UNKNOWN: lambda t: trained.unk_surface.encode(), BYTE: lambda t: bytes([int(t[3:5], 16)])}
        self.kinds, self.surfaces = kinds, [surfaces[k](t) for k, t in zip(kinds, texts)]
        # Characters of a piece; of byte pieces only the last of a character's has one.
        self._sizes = np.array([{NORMAL: len(t), UNKNOWN: 1}.get(k, 0) for k, t in zip(kinds, texts)], dtype=np.int64)
        self._is_byte = np.array([k == BYTE for k in kinds])
        self._continues = np.array([k == BYTE and 0x80 <= int(t[3:5], 16) < 0xC0 for k, t in zip(kinds, texts)])
        self._stretch = self._stretches()
        # Two generations: what the older one still has is taken over when it comes again.
        self.seen: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._id_of = np.full(0x110000, -1, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self._id_of[ord(piece)] = i
        self._cost_of = np.array([self.costs.get(t, np.inf) if k == NORMAL else np.inf for k, t in zip(kinds, texts)])
        self._pairs, self._makes = self._pair_table()

    def _stretches(self) -> re.Pattern[str]:
        """Stretches that no piece crosses the ends of, so that each is merged by itself: a
        character that is in no longer piece stands alone, no piece goes on after a word with
        the next space mark, and none has letters beside other characters. Where a piece goes
        on after a space mark the whole text is one stretch."""
        longer = [p.lstrip(SPACE) for p in self.ids if len(p) > 1]
        if any(SPACE in p for p in longer):
            return re.compile(".+", re.DOTALL)
        joined = sorted(set("".join(longer)))
        kinds = [[c for c in joined if c.isalpha()], [c for c in joined if not c.isalpha()]]
        if any(len({c.isalpha() for c in p}) > 1 for p in longer):
            kinds = [joined]
        runs = "|".join(f"[{''.join(map(re.escape, k))}]++" for k in kinds if k) or "(?!)"
        return re.compile(f"{SPACE}*+(?:{runs})|{SPACE}++|[^{''.join(map(re.escape, joined))}{SPACE}]", re.DOTALL)

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text; per character of it, and for its end, the byte of the source at
        which the prefix that gave it starts."""
        if not text:
            return "", np.zeros(1, dtype=np.int64)
        if self.map is None and not self.squeeze:
            codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
            lengths = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
            begin = [0, 0] if self.prefix else [0]
            starts = np.concatenate([begin, np.cumsum(lengths, dtype=np.int64)])
            return SPACE * self.prefix + text.replace(" ", SPACE), starts
        data = text.encode()
        at, out, starts = 0, [], []
        if self.squeeze:
            while at < len(data) and (part := self._prefix(data, at))[0] == b" ":
                at += part[1]
            if at == len(data):
                return "", np.zeros(1, dtype=np.int64)
        if self.prefix:
            out.append(SPACE)
            starts.append(at)
        after_space = self.squeeze
        while at < len(data):
            turned, length = self._prefix(data, at)
            part = turned.decode()
            part = part.lstrip(" ") if after_space else part
            out.extend(part.replace(" ", SPACE))
            starts.extend([at] * len(part))
            if part:
                after_space = self.squeeze and part.endswith(" ")
            at += length
        end = at
        while self.squeeze and out and out[-1] == SPACE:
            out.pop()
            end = starts.pop()
        return "".join(out), np.array([*starts, end], dtype=np.int64)

    def _prefix(self, data: bytes, at: int) -> tuple[bytes, int]:
        found = self.map.longest(data, at) if self.map else None
        if found:
            return found
        length = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
        return data[at : at + length], length

    def merged(self, text: str) -> list[str]:
        """The pieces of a stretch: of all neighbours that make a piece the one of the best
        score, the leftmost of equals, is merged until none is left. Neighbours wait in a
        heap, those that a merge has overtaken are passed over."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []
        costs = self.costs

        def offer(left: int) -> None:
            if left >= 0 and after[left] < len(parts):
                both = parts[left] + parts[after[left]]
                if both in costs:
                    heapq.heappush(heap, (costs[both], left, both))

        for left in range(len(parts) - 1):
            offer(left)
        while heap:
            _, left, both = heapq.heappop(heap)
            right = after[left]
            if parts[left] is None or right >= len(parts) or parts[left] + parts[right] != both:
                continue
            parts[left], parts[right] = both, None
            after[left] = after[right]
            if after[right] < len(parts):
                before[after[right]] = left
            offer(left)
            offer(before[left])
        return [p for p in parts if p is not None]

    def stretch_ids(self, text: str) -> bytes:
        """Ids of a stretch as 32-bit numbers; a character that is no piece is its bytes, or
        the unknown piece in models without byte pieces."""
        ids = array("i")
        for piece in self.merged(text):
            if piece in self.ids:
                ids.append(self.ids[piece])
            elif self.bytes:
                ids.extend(self.bytes[b] for b in piece.encode())
            else:
                ids.append(self.unknown)
        return ids.tobytes()

    def _pair_table(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of all pairs of pieces that make a piece, and what they make."""
        keys = {}
        for piece, made in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    keys[left * len(self.kinds) + right] = made
        ordered = sorted(keys.items()) or [(-1, 0)]
        return np.array([k for k, _ in ordered], dtype=np.int64), np.array([m for _, m in ordered], dtype=np.int32)

    def _made(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What pairs make and at which cost; infinite where they make nothing."""
        wanted = left.astype(np.int64) * len(self.kinds) + right
        place = np.minimum(np.searchsorted(self._pairs, wanted), len(self._pairs) - 1)
        made = self._makes[place]
        return made, np.where(self._pairs[place] == wanted, self._cost_of[made], np.inf)

    def _merge_words(self, words: list[str]) -> None:
        """`merged` for many stretches of one length at once: a round merges one pair of every
        stretch that has one, so all that go on are of one length again."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
        ids = self._id_of[points]
        whole = (ids >= 0).all(axis=1)
        for line in np.flatnonzero(~whole):  # characters that are no piece
            self.seen[words[line]] = self.stretch_ids(words[line])
        lines, ids = np.flatnonzero(whole), ids[whole]
        made, cost = self._made(ids[:, :-1], ids[:, 1:])
        while len(lines):
            if ids.shape[1] > 1:
                at = cost.argmin(axis=1)
                on = cost[np.arange(len(lines)), at] < np.inf
            else:
                on = np.zeros(len(lines), dtype=bool)
            for line, row in zip(lines[~on], ids[~on]):
                self.seen[words[line]] = row.tobytes()
            if not on.any():
                return
            lines, ids, made, cost, at = lines[on], ids[on], made[on], cost[on], at[on]
            rows, column = np.arange(len(lines)), np.arange(ids.shape[1] - 1)
            ids[rows, at] = made[rows, at]
            ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
            kept = column[:-1] + (column[:-1] >= at[:, None])
            made, cost = np.take_along_axis(made, kept, axis=1), np.take_along_axis(cost, kept, axis=1)
            for side in (at - 1, at):
                near = np.flatnonzero((side >= 0) & (side < cost.shape[1]))
                place = side[near]
                made[near, place], cost[near, place] = self._made(ids[near, place], ids[near, place + 1])

    def learn(self, stretches: Iterable[str]) -> list[str]:
        """Work out the ids of stretches that have not been seen; returns the long ones, which
        are not worth keeping."""
        if len(self.seen) > MOST_SEEN:
            self.seen, self._older = {}, self.seen
        by_length: dict[int, list[str]] = {}
        for text in set(stretches).difference(self.seen):
            known = self._older.get(text)
            if known is not None:
                self.seen[text] = known
            else:
                by_length.setdefault(len(text), []).append(text)
        for length, words in by_length.items():
            if 1 < length <= LONGEST_ROW:
                for first in range(0, len(words), ROWS):
                    self._merge_words(words[first : first + ROWS])
            else:
                self.seen.update((text, self.stretch_ids(text)) for text in words)
        return [text for length, words in by_length.items() if length > LONGEST_ROW for text in words]

    def encode_many(self, texts: Iterable[str | pa.StringScalar]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """`encode` of texts, some hundred thousand characters of them at a time."""
        normal, held = [], 0
        for text in texts:
            normal.append(self.normalise(text if isinstance(text, str) else text.as_py()))
            held += len(normal[-1][0])
            if held >= CHARACTERS:
                yield from self._encoded(normal)
                normal, held = [], 0
        yield from self._encoded(normal)

    def _encoded(self, normal: list[tuple[str, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        cut = [self._stretch.findall(text) for text, _ in normal]
        long = self.learn(chain.from_iterable(cut))
        for stretches, (_, starts) in zip(cut, normal):
            yield self._placed(stretches, starts)
        for text in long:
            self.seen.pop(text, None)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each one's source bytes begin and end. Of the byte pieces of a
        character the last one has its span, the others are empty."""
        return next(self.encode_many([text]))

    def _placed(self, stretches: list[str], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.frombuffer(b"".join(map(self.seen.__getitem__, stretches)), np.int32)
        sizes = self._sizes[ids]
        if self.bytes:
            goes_on = np.append(self._continues[ids[1:]], False)
            sizes[self._is_byte[ids] & ~goes_on[: len(ids)]] = 1
        ends = np.cumsum(sizes)
        if not self.bytes and len(ids):
            # Unknown characters in a row are one piece.
            kept = np.append(True, (ids[1:] != self.unknown) | (ids[:-1] != self.unknown))
            ends = ends[np.append(np.flatnonzero(kept)[1:], len(ids)) - 1]
            ids, sizes = ids[kept], np.diff(ends, prepend=0)
        return ids, starts[ends - sizes], starts[ends]

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: a space mark that opens it is left out, bytes that are no
        UTF-8 turn into a replacement mark each."""
        first, dropped = 0, 0
        strip = self.prefix or self.squeeze
        for first, i in enumerate(ids):
            # Controls are empty; byte pieces and unknown ones open the text as they are.
            if self.kinds[i] == CONTROL:
                continue
            if strip and self.kinds[i] == NORMAL and self.surfaces[i].startswith(b" "):
                dropped = 1
                if self.squeeze and self.surfaces[i] == b" ":
                    dropped = 0
                    continue
            break
        else:
            return ""
        data = b"".join([self.surfaces[i] for i in ids[first:]])
        return data[dropped:].decode("utf-8", "each_byte")


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encoded(docs: DataFrame, model: str = MODEL, back: str | None = None) -> DataFrame:
    """doc_id, ids, begins and ends of every whole text: its pieces and the bytes of the
    source each comes from; with `back` also the text that its ids are decoded to. Null and
    empty texts have no pieces; rows repeat as they come; other columns are left. No shuffle:
    a task holds one text and a batch of ids at a time.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "ids", "begins", "ends", *([back] if back else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)

        def packed(doc_ids: pa.Array, rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            offsets = pa.array(np.cumsum([0, *(len(r[0]) for r in rows)]), pa.int32())
            columns = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c))) for c in zip(*rows)]
            if back:
                columns.append(pa.array([pieces.decode(r[0].tolist()) for r in rows], pa.string()))
            return pa.RecordBatch.from_arrays([doc_ids, *columns], names)

        for batch in batches:
            rows, held, start = [], 0, 0
            for row in pieces.encode_many(batch["text"]):
                rows.append(row)
                held += len(row[0])
                if held >= IDS_PER_BATCH:
                    yield packed(batch["doc_id"].slice(start, len(rows)), rows)
                    rows, held, start = [], 0, start + len(rows)
            if rows:
                yield packed(batch["doc_id"].slice(start, len(rows)), rows)

    text_back = f", `{back}` string" if back else ""
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        cut, f"doc_id {id_type}, ids array<int>, begins array<long>, ends array<long>{text_back}"
    )


def decoded(ids: Column, model: str = MODEL) -> Column:
    """The text that a column of id lists stands for; an empty or null list is no text."""

    @F.arrow_udf("string")
    def text(lists: pa.Array) -> pa.Array:
        decode = piece_model(model).decode
        return pa.array([decode(ids.as_py() or []) for ids in lists], pa.string())

    return text(ids)


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces and back, told by digests."""
    pieces = encoded(read(spark, sf_dir, "documents"), back="decoded")
    return pieces.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.xxhash64("begins", "ends").alias("spans_xxhash64"),
    )
