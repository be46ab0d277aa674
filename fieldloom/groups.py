"""One step of a logistic fit on rows in whole groups, for code that runs inside tasks.

Apart from the operators, so that a worker loads nothing else for it.
"""

import numpy as np
import pyarrow as pa

# Rows whose shared entries are filled into one dense matrix at a time, and most inner steps.
_ROWS, _INNER = 8192, 100


def whole_groups(batches):
    """Batches sorted by ``key`` as tables that hold all rows of each key from 0 on."""
    kept = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_numpy()
        cut = np.searchsorted(keys, keys[-1]) if keys[-1] >= 0 else len(keys)
        if kept and keys[0] != kept[-1].column("key")[-1].as_py():
            yield pa.Table.from_batches(kept)
            kept = []
        if cut:
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = []
        if cut < len(keys):
            kept.append(batch.slice(cut))
    if kept:
        yield pa.Table.from_batches(kept)


class Groups:
    """Rows (key, label, indices, values) of whole groups.

    A row has entries of the ``shared`` indices and at most one other, which is its key and
    stands in no other group.
    """

    def __init__(self, table: pa.Table, shared: np.ndarray):
        table = table.combine_chunks()
        keys, indices = table["key"].to_numpy(), table["indices"].combine_chunks()
        entries, values = indices.flatten().to_numpy(), table["values"].combine_chunks().flatten().to_numpy()
        self.n, self.y = len(keys), table["label"].to_numpy()
        rows = np.repeat(np.arange(self.n), np.diff(indices.offsets.to_numpy()))
        place = np.searchsorted(shared, entries)
        found = np.append(shared, -1)[place] == entries
        # Column 0 of the shared ones is the intercept.
        self.width, self.rows, self.columns, self.values = len(shared) + 1, rows[found], place[found] + 1, values[found]
        self.x = np.zeros(self.n)
        self.x[rows[~found]] = values[~found]
        self.starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.keys = keys[self.starts]
        self.group = np.repeat(np.arange(len(self.starts)), np.diff(np.append(self.starts, self.n)))

    def _by_group(self, values):
        return np.bincount(self.group, values, len(self.starts))

    def solve(self, weights: np.ndarray, total: int, penalty: float):
        """The best coefficient of each group for these weights of the shared indices, with
        raw predictions, probabilities and the curvature of each group.

        Steps are damped by how far they move a raw prediction, so they never overshoot.
        """
        fixed = weights[0] + np.bincount(self.rows, self.values * weights[self.columns], self.n)
        reach = np.maximum.reduceat(np.abs(self.x), self.starts)
        own = np.zeros(len(self.starts))
        for _ in range(_INNER):
            raw = fixed + self.x * own[self.group]
            p = 0.5 * (1 + np.tanh(raw / 2))
            curvature = self._by_group(self.x * self.x * p * (1 - p)) / total + penalty
            step = (self._by_group(self.x * (p - self.y)) / total + penalty * own) / curvature
            move = np.maximum(np.abs(step) * reach, 1e-300)
            if np.abs(step).max() <= 1e-15 + 1e-12 * np.abs(own).max():
                break
            own = own - step * np.log1p(move) / move
        return own, raw, p, curvature

    def moments(self, weights: np.ndarray, total: int, penalty: float) -> np.ndarray:
        """Loss, slopes and curvature of the shared weights, with the groups' own coefficients
        always at their best: one flat array that adds up over groups."""
        own, raw, p, curvature = self.solve(weights, total, penalty)
        loss = (np.logaddexp(0, raw) - self.y * raw).sum() / total + penalty / 2 * (own * own).sum()
        spread = p * (1 - p) / total
        slopes, bend = np.zeros(self.width), np.zeros((self.width, self.width))
        tied = np.zeros((len(self.starts), self.width))
        for start in range(0, self.n, _ROWS):
            part = slice(start, min(start + _ROWS, self.n))
            low, high = np.searchsorted(self.rows, (part.start, part.stop))
            x = np.zeros((part.stop - start, self.width))
            x[:, 0] = 1.0
            x[self.rows[low:high] - start, self.columns[low:high]] = self.values[low:high]
            slopes += x.T @ (p[part] - self.y[part]) / total
            weighted = x * spread[part, None]
            bend += x.T @ weighted
            group = self.group[part]
            firsts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            tied[group[firsts]] += np.add.reduceat(weighted * self.x[part, None], firsts)
        bend -= tied.T @ (tied / curvature[:, None])
        return np.concatenate([[loss], slopes, bend.ravel()])
