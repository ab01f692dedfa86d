"""The best clusters of weighted numbers on a line."""

import numpy as np


def best_clusters(values: np.ndarray, weights: np.ndarray, k: int) -> list[float]:
    """Centres of the k clusters with the least sum of weighted squared distances, in order.

    Clusters of numbers on a line are runs of the sorted distinct values. The best split into
    j runs is found from the best splits into j - 1: as the end of the last run rises, its
    best beginning does not fall, so the ends are solved in halves, each within the bounds
    that the solved ones leave. Of equal splits the one whose last run is longest is taken.
    With k or more distinct values fewer than that, each is a centre of its own.
    """
    order = np.argsort(values, kind="stable")
    values, weights = np.asarray(values)[order], np.asarray(weights)[order]
    count = len(values)
    k = min(k, count)
    if k == 0:
        return []
    # Sums of whole numbers are exact, so that equal costs are equal.
    mass = np.append(0, np.cumsum(weights))
    first = np.append(0, np.cumsum(weights * values))
    second = np.append(0, np.cumsum(weights * values * values))

    def cost(begin: np.ndarray, end: int) -> np.ndarray:
        sums = (first[end] - first[begin]).astype(float)
        return (second[end] - second[begin]).astype(float) - sums * sums / (mass[end] - mass[begin]).astype(float)

    ends = np.arange(1, count + 1)
    sums = first[ends].astype(float)
    best = np.append(np.inf, second[ends].astype(float) - sums * sums / mass[ends].astype(float))
    begins = [np.zeros(count + 1, int)]
    for runs in range(2, k + 1):
        after, begin = np.full(count + 1, np.inf), np.zeros(count + 1, int)
        todo = [(runs, count, runs - 1, count - 1)]
        while todo:
            low, high, least, most = todo.pop()
            if low > high:
                continue
            end = (low + high) // 2
            options = np.arange(max(least, runs - 1), min(most, end - 1) + 1)
            costs = best[options] + cost(options, end)
            at = int(np.argmin(costs))
            after[end], begin[end] = costs[at], options[at]
            todo += [(low, end - 1, least, begin[end]), (end + 1, high, begin[end], most)]
        best = after
        begins.append(begin)
    centres, end = [], count
    for begin in reversed(begins):
        start = int(begin[end])
        centres.append(float(first[end] - first[start]) / float(mass[end] - mass[start]))
        end = start
    return centres[::-1]
