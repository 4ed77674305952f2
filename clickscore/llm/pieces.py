"""Piece encoding: N-best segmentations of the piece lattice, and decoding.

Texts are cut where no piece of the vocabulary can reach across, which leaves short parts
whose lattices are independent.  Distinct parts of a chunk are handled once: forward Viterbi
scores over all of them together, then, for the few parts whose second-best segmentation is
closest to the best, backward A-star search with the forward scores as exact heuristic.  The
N best segmentations of a text combine those.  Rows are handled in place, without a shuffle.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.llm import tokens as T
from clickscore.llm.frames import small_batches

SPACE = "▁"
N_BEST = 3
CHUNK_BYTES = 4 << 20
CUT_BITS = 20
#: Code points whose lattices are built at once.
CELLS = 30_000
NONE = -1


@dataclass
class Vocabulary:
    """Pieces with scores, and lookup tables over hashes of their code points."""

    texts: list[bytes]  # what each id decodes to, with spaces restored
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown: float
    longest: int
    tables: list[tuple[int, np.ndarray, np.ndarray]]  # shift, hash, id
    joined: np.ndarray  # may two neighbouring code points lie in one piece

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of hashes, or NONE."""
        out = np.full(len(hashes), NONE, np.int32)
        for shift, keys, ids in self.tables:
            at = ((hashes << np.uint64(shift)) >> np.uint64(46)).astype(np.int64)
            hit = keys[at] == hashes
            out[hit] = ids[at[hit]]
        return out


def code_hash(codes: np.ndarray) -> np.ndarray:
    return T.mix(codes.astype(np.uint64) + np.uint64(0x51ED27))


def cut_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return ((left.astype(np.uint64) * T.WORD_MIX[40] + right.astype(np.uint64) * T.WORD_MIX[41]) >> np.uint64(64 - CUT_BITS)).astype(np.int64)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def load_vocabulary(model_file: str) -> Vocabulary:
    """Read a SentencePiece model on the driver; tasks get the tables, not the file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    scores = np.array([model.get_score(i) for i in range(n)])
    byte_ids = np.full(256, NONE, np.int32)
    texts = [b""] * n
    normal = []
    for i, piece in enumerate(pieces):
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            texts[i] = bytes([int(piece[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            texts[i] = piece.replace(SPACE, " ").encode()
            normal.append(i)
    unknown = float(scores[normal][scores[normal] > -1e8].min()) - 10
    return build_vocabulary(pieces, normal, texts, scores, byte_ids, unknown)


def build_vocabulary(pieces, normal, texts, scores, byte_ids, unknown) -> Vocabulary:
    joined = np.zeros(1 << CUT_BITS, bool)
    hashes = np.zeros(len(normal), np.uint64)
    longest = 1
    for k, i in enumerate(normal):
        codes = codes_of(pieces[i])
        longest = max(longest, len(codes))
        if len(codes) > 1:
            joined[cut_key(codes[:-1], codes[1:])] = True
        value = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in code_hash(codes):
                value = value * T.STEP + c
        hashes[k] = value
    ids = np.array(normal, np.int32)
    tables, left = [], np.arange(len(ids))
    for shift in (0, 18, 36, 9, 27, 45):
        if not len(left):
            break
        at = ((hashes[left] << np.uint64(shift)) >> np.uint64(46)).astype(np.int64)
        keys, of = np.zeros(1 << 18, np.uint64), np.full(1 << 18, NONE, np.int32)
        place, first = np.unique(at, return_index=True)
        keys[place], of[place] = hashes[left[first]], ids[left[first]]
        tables.append((shift, keys, of))
        left = np.delete(left, first)
    if len(left):
        raise ValueError("two pieces share a hash")
    return Vocabulary(texts, scores, byte_ids, unknown, longest, tables, joined)


@dataclass
class Parts:
    """Best segmentations of distinct parts, and the loss of the second best."""

    best: np.ndarray
    loss: np.ndarray
    ids: list[np.ndarray]


def lattice(codes: np.ndarray, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Arcs of equally long parts: scores and ids, [end, length, part]; unknown is id NONE.

    One step per length, over all places and parts together.
    """
    n, size = codes.shape
    hashed = np.ascontiguousarray(code_hash(codes).T)
    reach = min(size, voc.longest)
    score = np.full((size + 1, reach + 1, n), -np.inf)
    ids = np.full((size + 1, reach + 1, n), NONE, np.int32)
    value, power = np.zeros((size, n), np.uint64), np.uint64(1)
    for length in range(1, reach + 1):
        with np.errstate(over="ignore"):
            value[length - 1 :] += hashed[: size - length + 1] * power
            power = power * T.STEP
        found = voc.find(value[length - 1 :].ravel()).reshape(-1, n)
        ids[length:, length] = found
        score[length:, length] = np.where(found != NONE, voc.scores[found], voc.unknown if length == 1 else -np.inf)
    return score, ids


def viterbi(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward scores, and the length of the best arc into each place (the shortest among equals)."""
    places, width, n = score.shape
    forward = np.full((places, n), -np.inf)
    forward[0] = 0
    length = np.ones((places, n), np.int64)
    row = np.arange(n)
    for end in range(1, places):
        far = min(end, width - 1)
        options = forward[end - far : end][::-1] + score[end, 1 : far + 1]
        best = options.argmax(axis=0)
        length[end] = best + 1
        forward[end] = options[best, row]
    return forward, length


def second_loss(score: np.ndarray, forward: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Best score less that of the best path with an arc off the best path; inf if none."""
    places, width, n = score.shape
    backward = np.full((places, n), -np.inf)
    backward[-1] = 0
    steps = np.arange(1, width)
    for start in range(places - 2, -1, -1):
        far = min(places - 1 - start, width - 1)
        arcs = score[start + steps[:far], steps[:far]]
        backward[start] = (arcs + backward[start + 1 : start + 1 + far]).max(axis=0)
    on_path = np.zeros((places, n), bool)
    row, at = np.arange(n), np.full(n, places - 1)
    while len(row):
        on_path[at, row] = True
        at = at - length[at, row]
        row, at = row[at > 0], at[at > 0]
    second = np.full(n, -np.inf)
    for step in range(1, width):
        through = forward[: places - step] + score[step:, step] + backward[step:]
        through[on_path[step:] & (length[step:] == step)] = -np.inf
        np.maximum(second, through.max(axis=0), out=second)
    return forward[-1] - second


def n_best_paths(score: np.ndarray, forward: np.ndarray, n: int) -> list[tuple[float, list[tuple[int, int]]]]:
    """The ``n`` best paths of one part by backward A-star; paths as (end, length) arcs.

    A hypothesis reaches back from the end to some place; its own score plus the forward
    score of that place is exactly the best it can become, so paths leave in order.  Of the
    hypotheses that reach a place only the ``n`` best can be part of the ``n`` best paths;
    others are dropped, and hypotheses share their arcs, so memory grows with the places.
    """
    last, width = len(forward) - 1, score.shape[1]
    order = 0
    agenda: list[tuple[float, int, int, float, tuple | None]] = [(-float(forward[last]), last, 0, 0.0, None)]
    reached: dict[int, list[float]] = {}
    out = []
    while agenda and len(out) < n:
        _, place, _, own, path = heapq.heappop(agenda)
        if place == 0:
            arcs = []
            while path is not None:
                arc, path = path
                arcs.append(arc)
            out.append((own, arcs))
            continue
        far = min(place, width - 1)
        heights = forward[place - far : place][::-1].tolist()
        for step, gain in enumerate(score[place, 1 : far + 1].tolist(), 1):
            if gain == -np.inf:
                continue
            total = own + gain
            best = reached.setdefault(place - step, [])
            if len(best) >= n:
                if total <= best[0]:
                    continue
                heapq.heapreplace(best, total)
            else:
                heapq.heappush(best, total)
            order += 1
            heapq.heappush(agenda, (-(total + heights[step - 1]), place - step, order, total, ((place, step), path)))
    return out


def path_ids(codes: np.ndarray, ids: np.ndarray, path: list[tuple[int, int]], voc: Vocabulary) -> list[int]:
    """Piece ids along a path; unknown code points become their bytes."""
    out: list[int] = []
    for end, step in path:
        found = int(ids[end, step])
        if found != NONE:
            out.append(found)
        else:
            out += byte_pieces(int(codes[end - 1]), voc)
    return out


def byte_pieces(code: int, voc: Vocabulary) -> list[int]:
    text = SPACE if code == LITERAL else chr(code)
    return [int(voc.byte_ids[b]) for b in text.encode("utf-8", "surrogatepass")]


#: Stands for a space mark that is in the text itself, which must not decode to a space.
LITERAL = 0x110000


def prepare(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with space marks, a mark before each text that has any."""
    text = data.tobytes().decode("utf-8")
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).copy()
    lead = (data & 0xC0) != 0x80
    before = np.concatenate(([0], np.cumsum(lead)))[offsets]
    codes[codes == ord(SPACE)] = LITERAL
    codes[codes == 0x20] = ord(SPACE)
    filled = np.flatnonzero(np.diff(before) > 0)
    codes = np.insert(codes, before[filled], ord(SPACE))
    added = np.zeros(len(before), np.int64)
    added[filled + 1] = 1
    return codes, before + np.cumsum(added)


def cut(codes: np.ndarray, first: np.ndarray, voc: Vocabulary) -> np.ndarray:
    """Starts of the independent parts, with the end of all."""
    if not len(codes):
        return np.zeros(1, np.int64)
    opens = np.ones(len(codes), bool)
    opens[1:] = ~voc.joined[cut_key(codes[:-1], codes[1:])]
    opens[first[:-1][first[:-1] < len(codes)]] = True
    return np.append(np.flatnonzero(opens), len(codes))


def distinct_parts(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First occurrence of each distinct part, and the distinct part of each occurrence."""
    size = np.diff(bounds)
    start = bounds[:-1]
    for salt in range(1, 20):
        place = np.arange(len(codes)) - np.repeat(start, size)
        value = (code_hash(codes) ^ np.uint64(salt)) * T.powers(int(size.max()))[place]
        hashes = T.mix(np.add.reduceat(value, start) + size.astype(np.uint64))
        _, at, of = np.unique(hashes, return_index=True, return_inverse=True)
        same = (size[at][of] == size).all() and bool(
            (codes[T.spread(start[at][of], size)] == codes).all()
        )
        if same:
            return at, of
    raise RuntimeError("hashes of parts keep colliding")


def blocks_of(size: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Places of equally long parts, not too many at once."""
    order = np.argsort(size, kind="stable")
    edges = np.flatnonzero(np.diff(size[order])) + 1
    for group in np.split(order, edges):
        length = int(size[group[0]])
        step = max(1, CELLS // length)
        for i in range(0, len(group), step):
            yield group[i : i + step], length


def solve(codes: np.ndarray, bounds: np.ndarray, at: np.ndarray, voc: Vocabulary) -> Parts:
    """Best segmentation of every distinct part."""
    start, size = bounds[:-1][at], np.diff(bounds)[at]
    best, loss = np.zeros(len(at)), np.full(len(at), np.inf)
    ids: list[np.ndarray] = [np.zeros(0, np.int32)] * len(at)
    for own, length in blocks_of(size):
        block = codes[start[own][:, None] + np.arange(length)]
        score, found = lattice(block, voc)
        forward, arc = viterbi(score)
        best[own] = forward[-1]
        loss[own] = second_loss(score, forward, arc)
        collect(own, block, found, arc, voc, ids)
    return Parts(best, loss, ids)


def collect(own, block, found, arc, voc, ids) -> None:
    """Follow the best arcs back from the end of all parts of a block at once."""
    n, size = block.shape
    row, at = np.arange(n), np.full(n, size)
    chosen = np.full((n, size), -2, np.int32)
    while len(row):
        step = arc[at, row]
        chosen[row, at - 1] = found[at, step, row]
        at = at - step
        row, at = row[at > 0], at[at > 0]
    used = chosen != -2
    ends = np.cumsum(used.sum(axis=1)).tolist()
    flat = chosen[used]
    odd = (chosen == NONE).any(axis=1)
    begin = 0
    for r, (k, end) in enumerate(zip(own.tolist(), ends)):
        if not odd[r]:
            ids[k] = flat[begin:end]
        else:
            out: list[int] = []
            for place in np.flatnonzero(used[r]).tolist():
                piece = int(chosen[r, place])
                out += [piece] if piece != NONE else byte_pieces(int(block[r, place]), voc)
            ids[k] = np.array(out, np.int32)
        begin = end


def part_n_best(parts: np.ndarray, codes, bounds, at, voc: Vocabulary, n: int) -> dict[int, list[tuple[float, list[int]]]]:
    """The ``n`` best segmentations, by A-star, of the given distinct parts."""
    start, size = bounds[:-1][at[parts]], np.diff(bounds)[at[parts]]
    out = {}
    for own, length in blocks_of(size):
        block = codes[start[own][:, None] + np.arange(length)]
        score, found = lattice(block, voc)
        forward = viterbi(score)[0]
        for r, k in enumerate(own):
            paths = n_best_paths(score[:, :, r], forward[:, r], n)
            out[int(parts[k])] = [(s, path_ids(block[r], found[:, :, r], p, voc)) for s, p in paths]
    return out


def combined(nearest: np.ndarray, parts: np.ndarray, ranked: dict, best: list[np.ndarray], n: int) -> list[tuple[float, dict[int, list[int]]]]:
    """The ``n`` best segmentations of a text: score loss and the parts that differ."""
    states: list[tuple[float, dict[int, list[int]]]] = [(0.0, {})]
    for k in nearest.tolist():
        paths = ranked[int(parts[k])]
        # Among equal scores the search may list another path first than the one taken.
        others = [(paths[0][0] - s, ids) for s, ids in paths if ids != best[int(parts[k])].tolist()]
        options = [(0.0, None), *others[: n - 1]]
        merged = [(a + b, d if o is None else d | {k: o}) for a, d in states for b, o in options]
        states = sorted(merged, key=lambda x: x[0])[:n]
    return states


def nearest(loss: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` smallest finite losses, earlier ones first among equals."""
    if n < len(loss):
        bar = np.partition(loss, n - 1)[n - 1] if n else -np.inf
        found = np.flatnonzero(loss <= bar)
    else:
        found = np.arange(len(loss))
    found = found[np.isfinite(loss[found])]
    return found[np.argsort(loss[found], kind="stable")][:n]


def encode_batches(batches: Iterator[pa.RecordBatch], voc: Vocabulary, n_best: int) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in T.chunked(batches, size=CHUNK_BYTES):
        n = batch.num_rows
        codes, first = prepare(data, offsets)
        bounds = cut(codes, first, voc)
        if len(codes):
            at, of = distinct_parts(codes, bounds)
            solved = solve(codes, bounds, at, voc)
        else:
            at, of = np.zeros(0, np.int64), np.zeros(0, np.int64)
            solved = Parts(np.zeros(0), np.zeros(0), [])
        n_ids = np.array([len(x) for x in solved.ids], np.int64)
        base = np.cumsum(n_ids) - n_ids
        every = np.concatenate(solved.ids) if len(n_ids) else np.zeros(0, np.int32)
        flat = every[T.spread(base[of], n_ids[of])]
        part_first = np.searchsorted(bounds[:-1], first)
        row = np.repeat(np.arange(n), np.diff(part_first))
        best = np.bincount(row, solved.best[of], minlength=n) if n else np.zeros(0)
        counts = np.bincount(row, n_ids[of], minlength=n).astype(np.int64)
        owned = [of[part_first[i] : part_first[i + 1]] for i in range(n)]
        # Only the parts with the smallest loss can differ in the n best of a text.
        near = [nearest(solved.loss[own], n_best - 1) for own in owned]
        wanted = np.unique(np.concatenate([own[k] for own, k in zip(owned, near)] or [of[:0]]))
        ranked = part_n_best(wanted, codes, bounds, at, voc, n_best) if len(wanted) else {}
        others: list[list] = []
        for i, (own, places) in enumerate(zip(owned, near)):
            shown = []
            for lost, changed in combined(places, own, ranked, solved.ids, n_best):
                pieces = sum(len(v) - int(n_ids[own[k]]) for k, v in changed.items()) + int(counts[i])
                swaps = [
                    {"at": int(n_ids[own[:k]].sum()), "removed": int(n_ids[own[k]]), "ids": v}
                    for k, v in sorted(changed.items())
                ]
                shown.append({"score": float(best[i] - lost), "n_pieces": pieces, "swaps": swaps})
            others.append(shown)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), T.ragged(flat, counts, pa.int32()),
                pa.array(best), pa.array(others, RANKED),
            ],
            names=["doc_id", "row_hash", "ids", "score", "n_best"],
        )


RANKED = pa.list_(
    pa.struct(
        [
            ("score", pa.float64()), ("n_pieces", pa.int64()),
            ("swaps", pa.list_(pa.struct([("at", pa.int32()), ("removed", pa.int32()), ("ids", pa.list_(pa.int32()))]))),
        ]
    )
)
RANKED_SQL = "array<struct<score double, n_pieces bigint, swaps array<struct<at int, removed int, ids array<int>>>>>"


def encode(docs: DataFrame, model_file: str, n_best: int = N_BEST) -> DataFrame:
    """Piece ids, score and the ``n_best`` best segmentations of every whole text.

    A space becomes the mark U+2581 and a text gets one mark in front; code points outside
    the vocabulary (and marks that are in the text itself) become byte pieces, so decoding
    gives the text back.  "Best" is by the sum of the scores that the model file gives its
    pieces.  In a file of merge ranks these are not log-probabilities, and the ids then differ
    from those of the file's own merging, which takes fewer pieces.  ``n_best`` lists segmentations in falling score, the first is
    ``ids``; the others are given as replacements ``(at, removed, ids)`` in it.  Fewer are
    listed when the text has fewer.  Ties keep a fixed order.

    NULL and empty texts have no pieces and score 0.  Repeated rows get equal results; texts
    of any length are read whole (a stretch that no piece boundary can cut takes some 300 bytes
    per code point while it is searched); an empty table gives an empty result.  Only ``doc_id`` and
    ``text`` are read.  The vocabulary (bounded by the model file) travels with the tasks.
    """
    small_batches(docs.sparkSession)
    voc = load_vocabulary(model_file)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("row_hash"), "text").mapInArrow(
        lambda it: encode_batches(it, voc, n_best),
        f"doc_id {kind}, row_hash bigint, ids array<int>, score double, n_best {RANKED_SQL}",
    )


def decode_batches(batches: Iterator[pa.RecordBatch], voc: Vocabulary) -> Iterator[pa.RecordBatch]:
    size = np.array([len(x) for x in voc.texts], np.int64)
    every = np.frombuffer(b"".join(voc.texts), np.uint8)
    base = np.cumsum(size) - size
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("ids"))
        counts = np.asarray(lists.value_lengths().fill_null(0), np.int64)
        ids = np.asarray(lists.flatten(), np.int64)
        ends = np.concatenate(([0], np.cumsum(counts)))
        texts = []
        for i in range(batch.num_rows):
            own = ids[ends[i] : ends[i + 1]]
            text = every[T.spread(base[own], size[own])].tobytes().decode("utf-8", "replace")
            texts.append(text.removeprefix(" "))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids`` (NULL and [] give '')."""
    voc = load_vocabulary(model_file)
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in encoded.schema)}, decoded string"
    return encoded.mapInArrow(lambda it: decode_batches(it, voc), schema)


def op6(docs: DataFrame, model_file: str) -> DataFrame:
    done = decode(encode(docs, model_file), model_file)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "score", "ids",
        F.transform("n_best", lambda x: x["score"]).alias("n_best_scores"),
        F.transform("n_best", lambda x: x["n_pieces"]).alias("n_best_pieces"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.xxhash64("decoded") == F.when(F.col("row_hash") == F.xxhash64(F.lit(None).cast("string")), F.xxhash64(F.lit("")))
         .otherwise(F.col("row_hash"))).alias("round_trip"),
    )
