"""Best few of many scored ids for several rows at once, merged batch by batch inside a task."""

from __future__ import annotations

import numpy as np

LOWEST = np.iinfo(np.int64).min


class TopK:
    """The ``k`` highest scores of each of ``rows``, ties by the smaller id; exact whatever the order of arrival."""

    def __init__(self, rows: int, k: int, distinct: bool):
        self.scores = np.full((rows, k), LOWEST, dtype=np.int64)
        self.ids = np.zeros((rows, k), dtype=np.int64)
        self.k, self.distinct = k, distinct

    @property
    def least(self) -> np.ndarray:
        """Score that a new id must reach, by row; ``LOWEST`` while there is room."""
        return self.scores[:, -1]

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Candidates in any order. With ``distinct`` an id that comes again with the same score counts once."""
        good = score >= self.least[row]
        row, score, ids = row[good], score[good], ids[good]
        if not len(row):
            return
        touched = np.unique(row)
        old_row, at = np.nonzero(self.scores[touched] > LOWEST)
        row = np.concatenate([touched[old_row], row])
        score = np.concatenate([self.scores[touched][old_row, at], score])
        ids = np.concatenate([self.ids[touched][old_row, at], ids])
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        if self.distinct:
            new = np.append(True, (row[1:] != row[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1]))
            row, score, ids = row[new], score[new], ids[new]
        starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        rank = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
        kept = rank < self.k
        self.scores[touched] = LOWEST
        self.scores[row[kept], rank[kept]] = score[kept]
        self.ids[row[kept], rank[kept]] = ids[kept]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, ids and scores held."""
        row, at = np.nonzero(self.scores > LOWEST)
        return row, self.ids[row, at], self.scores[row, at]
