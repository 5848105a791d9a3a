"""SentencePiece encoding and decoding, giant documents by a max-plus parallel scan.

The model is a merge (BPE) model.  A sequence of its pieces is the encoding of a
text exactly if every two neighbours are the encoding of their own text: merges
are chosen by score, then from the left, and within a stretch whose ends are
never merged over that order does not depend on the rest.  Encoding is therefore
a best path in a lattice whose nodes are piece occurrences and whose steps weigh 0
(neighbours fit) or minus infinity.  No piece has a space mark behind another
character, so words are apart, and each distinct word of a text is encoded once, by the library.

A document above ``chunk_chars`` is cut into chunks wherever the count falls.  The
states of a cut are the pieces that could lie across or end at it.  Each chunk
gives the matrix of best weights from the states of its first cut to those of its
second; the matrices of a document are combined associatively (max-plus prefix
products, in groups of bounded size up a tree and down again), which picks one state per cut, and every chunk
is then traced back on its own between its two states: the lattice is walked for
the words that the cuts lie in, the words between them are looked up.

Defined cases: null and empty text have no pieces; characters outside the
vocabulary become byte pieces; a space mark in the text is a space after
decoding; repeated rows are documents of their own; null ids are kept; an empty
table gives no rows; other columns are not read.  Models with a space mark inside a
piece, or with pieces of more than 32 characters, are refused.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import Recent, materialise, split_count, text_blocks

MARK = "▁"
ENCODED = "doc_id long, ids array<int>, n_chunks int"
_UNITS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
Node = tuple[int, int]  # first and last place of a piece


class PieceModel:
    """Vocabulary, neighbour test and the ids of words."""

    def __init__(self, path: str, most: int = 100_000, longest: int = 48):
        from sentencepiece import SentencePieceProcessor

        model = self.library = SentencePieceProcessor(model_file=path)
        normal = [
            i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.piece = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.id = {self.piece[i]: i for i in normal}
        self.score = {self.piece[i]: model.get_score(i) for i in normal}
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.raw = [p.replace(MARK, " ").encode() for p in self.piece]
        for b, i in enumerate(self.byte):
            self.raw[i] = bytes([b])
        self.reach = max(map(len, self.id))
        if any(MARK in p.lstrip(MARK) for p in self.id) or self.reach > 32:
            raise ValueError("pieces with a space mark inside, or of more than 32 characters, are not supported")
        self._edges: dict[str, tuple] = {}
        self._fits: dict[tuple[str, str], bool] = {}
        self._words, self._longest = Recent(most), longest
        self.stable = {p for p in self.id if self.edges(p) is not None}  # encoded as themselves

    def edges(self, piece: str) -> tuple | None:
        """Merges of a piece in their order: scores, and its outermost symbols before and after each.

        None if the piece's own text is encoded in another way.
        """
        held = self._edges.get(piece)
        if held is not None:
            return held
        symbols, steps, firsts, lasts = list(piece), [], [piece[0]], [piece[-1]]
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.score.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            steps.append(best)
            firsts.append(symbols[0])
            lasts.append(symbols[-1])
        found = (steps, firsts, lasts) if len(symbols) == 1 else None
        if found:
            if len(self._edges) >= 4000:
                self._edges.clear()
            self._edges[piece] = found
        return found

    def fits(self, left: str, right: str) -> bool:
        """Whether the text of two pieces is encoded as these two."""
        key = (left, right)
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 200_000:
                self._fits.clear()
            known = self._fits[key] = self._apart(left, right)
        return known

    def _apart(self, left: str, right: str) -> bool:
        (a_steps, _, a_last), (b_steps, b_first, _) = self.edges(left), self.edges(right)
        i = j = 0
        while True:
            across = self.score.get(a_last[i] + b_first[j])
            a = a_steps[i] if i < len(a_steps) else None
            b = b_steps[j] if j < len(b_steps) else None
            if across is not None and (a is None or across > a) and (b is None or across >= b):
                return False
            if a is None and b is None:
                return True
            # Equal scores go from the left.
            if b is None or (a is not None and a >= b):
                i += 1
            else:
                j += 1

    def forward(self, text: str, start: int, stop: int, first: str = "") -> dict[int, str]:
        """For each place, the piece that ends there on the path from ``start`` (behind the piece ``first``).

        There is one at most: the last piece of the encoding of the text up to there.
        """
        last, stable, fits, reach = {start: first}, self.stable, self._fits, self.reach
        for at in range(start + 1, stop + 1):
            for low in range(at - reach if at - reach > start else start, at):
                piece = text[low:at]
                if piece not in stable and low != at - 1:
                    continue
                before = last.get(low)
                if before is None:
                    continue
                if before:
                    fit = fits.get((before, piece))
                    if fit is None:
                        fit = self.fits(before, piece)
                    if not fit:
                        continue
                last[at] = piece
                break
        return last

    def traced(self, last: dict[int, str], start: int, stop: int) -> list[str]:
        out = []
        while stop > start:
            out.append(last[stop])
            stop -= len(last[stop])
        return out[::-1]

    def ids(self, pieces: list[str]) -> list[int]:
        out = []
        for piece in pieces:
            number = self.id.get(piece)
            if number is None:
                out += [self.byte[b] for b in piece.encode()]
            else:
                out.append(number)
        return out

    def words(self, units: list[str]) -> list[bytes]:
        """Ids of distinct words, each with its space marks in front."""
        return self._words.values(units, self._solve, lambda unit: len(unit) <= self._longest)

    def _solve(self, units: list[str]) -> list[bytes]:
        # The library puts one mark in front, but not before nothing.
        found = self.library.encode([u[1:].replace(MARK, " ") for u in units], num_threads=1)
        alone = self.ids([MARK])
        found = [alone if u == MARK else ids for u, ids in zip(units, found)]
        raw = np.array([i for ids in found for i in ids], "<i4").tobytes()
        stops = (4 * np.cumsum([len(ids) for ids in found])).tolist()
        return [raw[a:b] for a, b in zip([0, *stops[:-1]], stops)]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, with the space that encoding puts in front taken away."""
        return b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=1)
def piece_model(path: str) -> PieceModel:
    """One per Python worker, kept from task to task."""
    return PieceModel(path)


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK)


class Chunk:
    """The characters from ``a`` to ``b`` of ``text``, which reaches past both as far as a piece may."""

    def __init__(self, model: PieceModel, text: str, a: int, b: int, first: bool, final: bool):
        self.model, self.text, self.a, self.b, self.first, self.final = model, text, a, b, first, final
        cuts = [p for p in range(max(1, a), b + 1) if p < len(text) and text[p] == MARK and text[p - 1] != MARK]
        self.cuts = [0, *cuts] if first and a == 0 else cuts

    def states(self, cut: int) -> list[Node]:
        """Pieces that lie across or end at a cut; a place by itself at both ends of the document."""
        if (self.first and cut == self.a) or (self.final and cut == self.b):
            return [(cut, cut)]
        text, found = self.text, []
        for start in range(max(0, cut - self.model.reach), cut):
            for stop in range(cut, min(len(text), start + self.model.reach) + 1):
                piece = text[start:stop]
                if len(piece) == 1 or piece in self.model.stable:
                    found.append((start, stop))
        return found

    def _leaving(self, last: dict[int, str], exits: list[Node]) -> list[int]:
        """Exit states on the path."""
        found = []
        for j, (start, stop) in enumerate(exits):
            piece = last.get(stop)
            if start == stop:
                if piece is not None:
                    found.append(j)
            elif piece is not None and len(piece) == stop - start and start in last:
                found.append(j)
        return found

    def _end(self) -> int:
        return len(self.text) if not self.final else self.b

    def matrix(self) -> tuple[list[Node], list[Node], np.ndarray]:
        """Entry states, exit states and best weights between them."""
        model, text = self.model, self.text
        entries, exits = self.states(self.a), self.states(self.b)
        best = np.full((len(entries), len(exits)), -np.inf)
        # A state that ends at the cut is the last piece of the word before it.
        cuts = [c for c in self.cuts if c < self.b]
        ways = self._leaving(model.forward(text, cuts[-1], self._end()), exits) if cuts else []
        for i, (start, stop) in enumerate(entries):
            if cuts and stop <= cuts[0]:
                head = model.forward(text, stop, cuts[0], text[start:stop])
                if cuts[0] in head:
                    best[i, ways] = 0.0
            else:
                best[i, self._leaving(self._path(start, stop), exits)] = 0.0
        return entries, exits, best

    def _path(self, start: int, stop: int) -> dict[int, str]:
        """Path from an entry state through the whole chunk, beginning anew at each word."""
        model, text = self.model, self.text
        last = {stop: text[start:stop]}
        end, at = self._end(), stop
        for cut in [c for c in self.cuts if c > stop] + [end]:
            part = model.forward(text, at, cut, last[at])
            last |= part
            if cut not in last:
                return {}
            if cut != end:
                at = cut
        return last

    def traced(self, entry: Node, exit_: Node) -> tuple[list[int], str, list[int]]:
        """What is behind the entry state, up to the exit state: ids, whole words (as text with marks), ids."""
        model, text = self.model, self.text
        cuts = [c for c in self.cuts if entry[1] <= c <= exit_[0]]
        if len(cuts) < 2:
            return model.ids(model.traced(self._path(*entry), entry[1], exit_[1])), "", []
        first, last = cuts[0], cuts[-1]
        head = model.traced(model.forward(text, entry[1], first, text[slice(*entry)]), entry[1], first)
        tail = model.traced(model.forward(text, last, exit_[1]), last, exit_[1])
        return model.ids(head), text[first:last], model.ids(tail)


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None]).max(axis=1)


def prefix_products(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Products of the first 1, 2, ... matrices, by pairs (the product is associative)."""
    if len(matrices) < 2:
        return matrices
    pairs = [max_plus(x, y) for x, y in zip(matrices[::2], matrices[1::2])]
    even = prefix_products(pairs)
    out = [matrices[0]]
    for i in range(1, len(matrices)):
        out.append(even[i // 2] if i % 2 else max_plus(even[i // 2 - 1], matrices[i]))
    return out


def chosen_states(matrices: list[np.ndarray], first: int = 0, final: int = 0) -> list[int]:
    """The state of each cut on the best path between states of the first and the last cut."""
    ahead = prefix_products(matrices)
    states = [final]
    for i in range(len(matrices) - 1, 0, -1):
        states.append(int((ahead[i - 1][first] + matrices[i][:, states[-1]]).argmax()))
    return [first, *states[::-1]]


MATRICES = "row long, at long, entries array<int>, exits array<int>, best array<double>"
CHOSEN = "row long, at long, entry int, exit int"


def _matrices(rows: list[dict]) -> list[np.ndarray]:
    return [np.array(r["best"]).reshape(len(r["entries"]) // 2, -1) for r in rows]


def scanned(matrices: DataFrame, fan: int = 256) -> DataFrame:
    """row, at, and which entry and exit state each matrix has on its document's best path.

    Up to ``fan`` consecutive matrices of a document are combined by a task at a time, as
    often as it takes, and the states are picked from the whole down to the parts.
    """

    def product(table: pa.Table) -> pa.Table:
        rows = table.sort_by("at").to_pylist()
        whole = prefix_products(_matrices(rows))[-1]
        row = {"row": rows[0]["row"], "at": rows[0]["at"] // fan, "entries": rows[0]["entries"], "exits": rows[-1]["exits"], "best": whole.ravel().tolist()}
        return pa.Table.from_pylist([row], table.schema)

    def pick(parts: pa.Table, above: pa.Table) -> pa.Table:
        rows, told = parts.sort_by("at").to_pylist(), above.to_pylist()
        if not rows:
            return pa.table({n: pa.array([], t) for n, t in (("row", pa.int64()), ("at", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()))})
        states = chosen_states(_matrices(rows), *((told[0]["entry"], told[0]["exit"]) if told else (0, 0)))
        return pa.table({
            "row": pa.array([r["row"] for r in rows], pa.int64()), "at": pa.array([r["at"] for r in rows], pa.int64()),
            "entry": pa.array(states[:-1], pa.int32()), "exit": pa.array(states[1:], pa.int32()),
        })

    levels = [matrices]
    most = matrices.agg(F.max("at")).first()[0] or 0
    while most >= fan:
        groups = levels[-1].withColumn("over", F.floor(F.col("at") / fan)).groupBy("row", "over")
        levels.append(materialise(groups.applyInArrow(lambda t: product(t.drop_columns("over")), MATRICES), "products"))
        most //= fan
    chosen = matrices.sparkSession.createDataFrame([], CHOSEN)
    for level in reversed(levels):
        over = F.floor(F.col("at") / fan)
        parts = level.withColumn("over", over).groupBy("row", "over")
        chosen = materialise(parts.cogroup(chosen.withColumn("over", F.col("at")).groupBy("row", "over")).applyInArrow(pick, CHOSEN), "states")
    return chosen


def encode(
    docs: DataFrame, model_path: str, chunk_chars: int = 16_384, id_col: str = "doc_id", text_col: str = "text",
    then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None, schema: str = ENCODED,
) -> DataFrame:
    """Per document: doc_id, ids, n_chunks.

    ``then`` works on these rows where they arise and gives rows of ``schema``: as a map of its
    own it would keep a second Python worker, with a second model, beside each task's first.
    """
    reach = 64
    if chunk_chars < reach:
        raise ValueError("a chunk must be longer than any piece")
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    giant = F.length("text") >= chunk_chars

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for block in text_blocks(batches, "text"):
            ids, stops = encoded_block(model, block.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, stops].astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), lists, pa.array(np.ones(len(stops), np.int32))], names=["doc_id", "ids", "n_chunks"]
            )

    def whole_then(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return then(whole(batches)) if then else whole(batches)

    short = narrow.where(~giant).mapInArrow(whole_then, schema)

    long = materialise(narrow.where(giant).withColumn("row", F.monotonically_increasing_id()), "giants")
    with_mark = F.concat(F.lit(MARK), F.replace("text", F.lit(" "), F.lit(MARK)))
    cut = (
        long.select("row", with_mark.alias("marked"))
        .select("row", "marked", F.length("marked").alias("size"))
        .withColumn("a", F.explode(F.sequence(F.lit(0), F.col("size") - 1, F.lit(chunk_chars))))
        .withColumn("b", F.least(F.col("a") + chunk_chars, "size"))
        .withColumn("from", F.greatest(F.col("a") - reach, F.lit(0)))
        .select("row", "a", "b", "from", (F.col("b") == F.col("size")).alias("final"),
                F.substring("marked", F.col("from") + 1, F.col("b") + reach - F.col("from")).alias("text"))
    )
    # Some megabytes of text in a partition.
    chunks = long.agg(F.sum(F.ceil((F.length("text") + 1) / chunk_chars))).first()[0] or 0
    cut = materialise(cut.repartition(split_count(chunks, max(1, (8 << 20) // chunk_chars), least=8), "row", "a"), "chunks")

    def chunk(model: PieceModel, r: dict) -> Chunk:
        return Chunk(model, r["text"], r["a"] - r["from"], r["b"] - r["from"], r["a"] == 0, r["final"])

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for block in text_blocks(batches, "text"):
            rows = []
            for r in block.to_pylist():
                entries, exits, best = chunk(model, r).matrix()
                places = [[r["from"] + x for node in nodes for x in node] for nodes in (entries, exits)]
                rows.append({"row": r["row"], "at": r["a"] // chunk_chars, "entries": places[0], "exits": places[1], "best": best.ravel().tolist()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("row", pa.int64()), ("at", pa.int64()), ("entries", pa.list_(pa.int32())), ("exits", pa.list_(pa.int32())),
                ("best", pa.list_(pa.float64())),
            ]))

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for block in text_blocks(batches, "text"):
            rows = block.to_pylist()
            found = []
            for r in rows:
                ends = [tuple(x - r["from"] for x in r[name][2 * r[at] : 2 * r[at] + 2]) for name, at in (("entries", "entry"), ("exits", "exit"))]
                found.append(chunk(model, r).traced(*ends))
            inner, stops = encoded_block(model, pa.array([words[1:].replace(MARK, " ") for _, words, _ in found], pa.string()))
            ids = [
                np.concatenate([np.array(head, np.int32), inner[a:b], np.array(tail, np.int32)])
                for (head, _, tail), a, b in zip(found, [0, *stops[:-1].tolist()], stops.tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [block.column("row"), block.column("a"), pa.array(ids, pa.list_(pa.int32()))], names=["row", "a", "ids"]
            )

    at = F.floor(F.col("a") / chunk_chars).cast("long")
    weights = materialise(cut.mapInArrow(matrices, MATRICES), "matrices")
    ends = scanned(weights).join(weights.drop("best"), ["row", "at"])
    parts = cut.withColumn("at", at).join(ends, ["row", "at"]).mapInArrow(trace, "row long, a int, ids array<int>")
    joined = parts.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("a", "ids"))).alias("parts"))
    tall = long.select("row", "doc_id").join(joined, "row").select(
        "doc_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), F.size("parts").alias("n_chunks")
    )
    return short.unionByName(tall.mapInArrow(then, schema) if then else tall)


def encoded_block(model: PieceModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other and where each ends; words between single spaces are looked up together."""
    plain = pc.and_(
        pc.invert(pc.match_substring_regex(texts, f"  |^ | $|{MARK}")), pc.greater(pc.binary_length(texts), 0)
    ).to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(texts.filter(pa.array(plain)), " ")
    rest = [_UNITS.findall(marked(t)) if t else [] for t in texts.filter(pa.array(~plain)).to_pylist()]
    # Words of plain texts have no mark yet; units of the others have theirs, one or more.
    words = pa.concat_arrays([
        pc.binary_join_element_wise(pa.scalar(MARK), lists.flatten(), ""), pa.array([u for units in rest for u in units], pa.string()),
    ])
    coded = words.dictionary_encode()
    each = model.words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    flat = np.frombuffer(b"".join(each), "<i4")
    length = np.fromiter(map(len, each), np.int64, len(each)) // 4
    place = coded.indices.to_numpy()
    taken = length[place]
    stops = np.cumsum(taken)
    start = (np.cumsum(length) - length)[place]
    ids = flat[np.repeat(start - (stops - taken), taken) + np.arange(int(taken.sum()))]
    if plain.all():
        return ids, stops[lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py() - 1]
    # Back in the order of the texts.
    order = np.r_[np.flatnonzero(plain), np.flatnonzero(~plain)]
    sizes = np.r_[pc.list_value_length(lists).to_numpy(), [len(units) for units in rest]].astype(np.int64)
    ends = np.r_[0, stops][np.cumsum(sizes)]
    parts = np.split(ids, ends[:-1])
    out: list[np.ndarray] = [ids[:0]] * len(texts)
    for row, part in zip(order.tolist(), parts):
        out[row] = part
    return np.concatenate(out), np.cumsum([len(o) for o in out])


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text of doc_id, ids."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                found = [model.decode(np.asarray(ids, np.int32)) if ids else "" for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, text string")


DIGESTS = "doc_id long, n_ids long, ids_crc32 long, n_chunks int, decoded_chars long, decoded_crc32 long"


def _digest(model_path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                ids = [np.asarray(x, "<i4") if x is not None else np.zeros(0, "<i4") for x in part.column("ids").to_numpy(zero_copy_only=False)]
                texts = [model.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()), part.column("n_chunks"),
                        pa.array([len(t) for t in texts], pa.int64()), pa.array([zlib.crc32(t.encode()) for t in texts], pa.int64()),
                    ],
                    names=["doc_id", "n_ids", "ids_crc32", "n_chunks", "decoded_chars", "decoded_crc32"],
                )

    return digest


def digests(encoded: DataFrame, model_path: str) -> DataFrame:
    """Per document: number and CRC-32 of its ids (little-endian 32-bit), and characters and CRC-32 of the decoded text."""
    return encoded.mapInArrow(_digest(model_path), DIGESTS)


def encode_digests(
    docs: DataFrame, model_path: str, chunk_chars: int = 16_384, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """:func:`digests` of :func:`encode`, worked out in the tasks that encode."""
    return encode(docs, model_path, chunk_chars, id_col, text_col, _digest(model_path), DIGESTS)
