"""How many rows of each stratum go to which other stratum (a helper on tables of counts)."""

from __future__ import annotations

import numpy as np


def cheapest_transport(supply: np.ndarray, demand: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """As many units as can be moved and, among these, at the least total cost.

    ``cost`` holds a whole number for each pair of a source and a target, infinity where none may go.
    Units are sent along cheapest paths, which may take back what an earlier path sent.
    """
    left, room = supply.astype(np.int64), demand.astype(np.int64)
    flow = np.zeros(cost.shape, np.int64)
    while cost.size:
        to_source = np.where(left > 0, 0.0, np.inf)
        to_target = np.full(len(room), np.inf)
        from_source, from_target = np.zeros(len(room), int), np.full(len(left), -1)
        changed = True
        while changed:
            ahead = to_source[:, None] + cost
            best = ahead.min(0)
            nearer = best < to_target
            to_target[nearer], from_source[nearer] = best[nearer], ahead.argmin(0)[nearer]
            back = np.where(flow > 0, to_target - np.where(flow > 0, cost, 0), np.inf)
            best = back.min(1)
            shorter = best < to_source
            to_source[shorter], from_target[shorter] = best[shorter], back.argmin(1)[shorter]
            changed = bool(nearer.any() or shorter.any())
        open_to = np.where(room > 0, to_target, np.inf)
        if not np.isfinite(open_to).any():
            break
        end = target = int(open_to.argmin())
        path, most = [], int(room[end])
        while True:
            source = int(from_source[target])
            path.append((source, target, 1))
            target = int(from_target[source])
            if target < 0:
                break
            path.append((source, target, -1))
            most = min(most, int(flow[source, target]))
        most = min(most, int(left[source]))
        for i, j, sign in path:
            flow[i, j] += sign * most
        left[source] -= most
        room[end] -= most
    return flow
