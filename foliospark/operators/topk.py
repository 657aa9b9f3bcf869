"""Best k rows per query, kept while a task walks over its own rows."""

from __future__ import annotations

import numpy as np
import pandas as pd


class BestRows:
    """Running top k per query; ties go to the smaller row id.

    A task emits at most k rows per query, so what is shuffled for the final
    ranking does not depend on the number of rows searched.
    """

    def __init__(self, k: int, queries: int):
        self.k = k
        self.floor = np.full(queries, -np.inf)
        self.best = pd.DataFrame({"query": pd.Series(dtype="int64"), "id": [], "score": pd.Series(dtype="float64")})

    def add(self, scores: np.ndarray, ids: np.ndarray, valid: np.ndarray | None = None) -> None:
        """``scores`` is rows x queries."""
        keep = scores >= self.floor
        if valid is not None:
            keep &= valid
        rows, queries = np.nonzero(keep)
        if not len(rows):
            return
        fresh = pd.DataFrame({"query": queries, "id": ids[rows], "score": scores[rows, queries]})
        merged = fresh if self.best.empty else pd.concat([self.best, fresh], ignore_index=True)
        merged = merged.sort_values(["query", "score", "id"], ascending=[True, False, True], ignore_index=True)
        place = merged.groupby("query", sort=False).cumcount()
        self.best = merged[place < self.k]
        last = merged[place == self.k - 1]
        self.floor[last["query"].to_numpy()] = last["score"].to_numpy()
