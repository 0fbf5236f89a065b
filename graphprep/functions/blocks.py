"""Blocked scoring inside one task: inner products of two matrices, of which only the best rows are kept."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

QUESTION_BLOCK = 256
ENTITY_BLOCK = 4096
#: Entities that a question block is shown first, to reach scores that others can be held against.
FIRST_BLOCK = 512
#: Twice the relative rounding error of a score in single precision, and more than that of sums in double.
ROUNDING = 1e-6
#: More than twice the unit rounding of single precision, and than the step of its least numbers; norms it is used for.
SINGLE, TINY = 1.2e-7, 2e-45
ORDINARY = 1e-15, 1e15
HITS = "question_id long, k int, partition int, index int, dist float"
HITS_ARROW = pa.schema(
    [
        ("question_id", pa.int64()),
        ("k", pa.int32()),
        ("partition", pa.int32()),
        ("index", pa.int32()),
        ("dist", pa.float32()),
    ]
)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of equally long vectors as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if flat.size % len(column) or column.null_count or len(set(np.diff(column.offsets.to_numpy()))) > 1:
        raise ValueError("all vectors must have the same dimension")
    return flat.reshape(len(column), -1).astype(np.float64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of each row by score, ties by lowest id. Short rows are left as they are."""
    if scores.shape[1] > k:
        threshold = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        tied = scores == threshold
        surplus = (scores >= threshold).sum(axis=1) > k
        keep = scores > threshold
        if surplus.any():
            # Put the ids in order within the tied cells of the rows where not all of them fit.
            for row in np.flatnonzero(surplus):
                cells = np.flatnonzero(tied[row])
                wanted = k - int(keep[row].sum())
                first = cells[np.argpartition(ids[row, cells], wanted - 1)[:wanted]]
                tied[row] = False
                tied[row, first] = True
        keep |= tied
        scores, ids = scores[keep].reshape(-1, k), ids[keep].reshape(-1, k)
    return scores, ids


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


def side_by_side(rows: np.ndarray, values: np.ndarray, n: int, empty) -> np.ndarray:
    """Values sorted by row as a matrix of ``n`` rows, short ones filled up with ``empty``."""
    sizes = np.bincount(rows, minlength=n)
    starts = np.cumsum(sizes) - sizes
    out = np.full((n, int(sizes.max(initial=0))), empty, values.dtype)
    out[rows, np.arange(len(rows)) - starts[rows]] = values
    return out


class Scorer:
    """Keeps the best k entities of each (question, partition) over the batches it is shown.

    Questions are worked through in blocks of similar k, so one large k does not inflate the others. Entities are worked
    through by falling norm: a product is at most the product of the norms, so once that is below the k-th best score of every
    question of a block, the rest of the batch is passed over. Once a block has k scores, products in single precision say
    which entities could be better, by the greatest error they can have; only those are scored in double. ``floors`` gives, for a partition, scores already known to be
    reached by k entities for each question. ``scored`` and ``skipped`` count (question block, entity) pairs.
    """

    def __init__(self, question_ids: np.ndarray, vectors: np.ndarray, ks: np.ndarray, floors: dict[int, np.ndarray] | None = None):
        order = np.argsort(ks, kind="stable")
        self.blocks = [
            (question_ids[rows], ks[rows], vectors[rows])
            for rows in (order[start : start + QUESTION_BLOCK] for start in range(0, len(order), QUESTION_BLOCK))
        ]
        self.norms = [norms(vectors) for _, _, vectors in self.blocks]
        self.singles = [vectors.astype(np.float32) if self._ordinary(asked) else None for (_, _, vectors), asked in zip(self.blocks, self.norms)]
        cuts = range(QUESTION_BLOCK, len(order), QUESTION_BLOCK)
        self.floors = {partition: np.split(known[order], cuts) for partition, known in (floors or {}).items()}
        self.scored = self.skipped = 0
        self.clear()

    @staticmethod
    def _ordinary(lengths: np.ndarray) -> bool:
        """Whether products with such vectors can be estimated in single precision."""
        return bool(((lengths == 0) | ((lengths > ORDINARY[0]) & (lengths < ORDINARY[1]))).all())

    def clear(self) -> None:
        self.kept: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.size = 0

    def least_norm(self, partition: int, number: int, k: int) -> float:
        """Entities with a smaller norm than this have no place among the best k of any question of a block."""
        reached = np.full(len(self.norms[number]), -np.inf)
        if partition in self.floors:
            reached = np.maximum(reached, self.floors[partition][number])
        kept = self.kept.get((partition, number))
        if kept is not None and kept[0].shape[1] >= k:
            reached = np.maximum(reached, kept[0].min(axis=1))
        asked = self.norms[number]
        with np.errstate(divide="ignore", invalid="ignore"):
            # Scores are rounded to single precision: what might be rounded up to the k-th best is not passed over.
            least = np.where((asked > 0) & (reached > 0), reached / asked * (1 - ROUNDING), -np.inf)
        return float(least.min()) if len(least) else np.inf

    def _rivals(self, key: tuple[int, int], k: int, embeddings: np.ndarray, single: np.ndarray | None, longest: float) -> tuple[np.ndarray, np.ndarray] | None:
        """``(question, entity)`` places, by question, of all that might be among the best k; None if they are not few."""
        number, kept = key[1], self.kept.get(key)
        if single is None or self.singles[number] is None or kept is None or kept[0].shape[1] < k:
            return None
        reached, asked, dimension = kept[0].min(axis=1).astype(np.float64), self.norms[number], embeddings.shape[1]
        error = (dimension + 8) * SINGLE * asked * longest + dimension * TINY * (1 + asked + longest)
        least = np.where(np.isfinite(reached), reached - error - SINGLE * np.abs(reached), -np.inf)
        # Rounded down: the bound is compared in single precision.
        bound = np.nextafter(least.astype(np.float32), np.float32(-np.inf))
        near = self.singles[number] @ single.T >= bound[:, None]
        rows, columns = np.divmod(np.flatnonzero(near), near.shape[1])
        return (rows, columns) if 8 * len(rows) <= near.size else None

    def add(self, partitions: np.ndarray, indexes: np.ndarray, embeddings: np.ndarray) -> None:
        lengths = norms(embeddings)
        indexes = indexes.astype(np.int32)
        for partition in np.unique(partitions):
            rows = np.flatnonzero(partitions == partition)
            rows = rows[np.argsort(-lengths[rows], kind="stable")]
            cuts = [*range(0, min(len(rows), ENTITY_BLOCK), FIRST_BLOCK)][:2] + [*range(ENTITY_BLOCK, len(rows), ENTITY_BLOCK)]
            ordered, own = embeddings[rows], indexes[rows]
            single = ordered.astype(np.float32) if self._ordinary(lengths[rows]) else None
            for number, (_, ks, vectors) in enumerate(self.blocks):
                k, key = int(ks.max()), (int(partition), number)
                for start, stop in zip(cuts, [*cuts[1:], len(rows)]):
                    least = self.least_norm(*key, k)
                    if lengths[rows[start]] < least:
                        self.skipped += len(rows) - start
                        break
                    end = start + int(np.searchsorted(-lengths[rows[start:stop]], -least, side="right"))
                    self.scored += end - start
                    self.skipped += stop - end
                    part, ids = ordered[start:end], own[start:end]
                    rivals = self._rivals(key, k, part, None if single is None else single[start:end], float(lengths[rows[start]]))
                    if rivals is None:
                        scores = (vectors @ part.T).astype(np.float32)
                        scores, ids = best(scores, np.broadcast_to(ids, scores.shape), k)
                    elif len(rivals[0]):
                        asked, found = rivals
                        products = np.einsum("ij,ij->i", vectors[asked], part[found]).astype(np.float32)
                        scores = side_by_side(asked, products, len(vectors), -np.inf)
                        ids = side_by_side(asked, ids[found], len(vectors), np.iinfo(np.int32).max)
                    else:
                        continue
                    if key in self.kept:
                        old_scores, old_ids = self.kept[key]
                        self.size -= old_scores.size
                        scores = np.concatenate([old_scores, scores], axis=1)
                        scores, ids = best(scores, np.concatenate([old_ids, ids], axis=1), k)
                    self.kept[key] = (scores, np.array(ids))
                    self.size += scores.size

    def drain(self) -> Iterator[pa.RecordBatch]:
        """Hand out what is kept and forget it; the caller ranks it again."""
        kept = self.kept
        self.clear()
        for (partition, number), (scores, ids) in kept.items():
            question_ids, ks, _ = self.blocks[number]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(question_ids, scores.shape[1]), pa.int64()),
                    pa.array(np.repeat(ks, scores.shape[1]), pa.int32()),
                    pa.array(np.full(scores.size, partition), pa.int32()),
                    pa.array(ids.ravel(), pa.int32()),
                    pa.array(scores.ravel(), pa.float32()),
                ],
                schema=HITS_ARROW,
            )
