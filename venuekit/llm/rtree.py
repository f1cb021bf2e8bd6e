"""An R-tree over vectors of counts, and the pairs of points in two trees that may overlap enough."""

from __future__ import annotations

from collections.abc import Iterator

LEAF = 16


class CountTree:
    """Points with sizes and labels, packed into boxes by median splits of the widest coordinate.

    A node keeps the largest count of each coordinate below it, the smallest size, and the label if there is only one.
    """

    def __init__(self, counts, sizes, labels):
        import numpy as np

        self.counts, self.sizes, self.labels = counts, sizes, labels
        self.most, self.least, self.single, self.below = [], [], [], []
        open_ = [(np.arange(len(counts)), -1)]
        while open_:
            at, above = open_.pop()
            node, own = len(self.most), counts[at]
            if above >= 0:
                self.below[above].append(node)
            self.most.append(own.max(axis=0))
            self.least.append(int(sizes[at].min()))
            same = (labels[at] == labels[at[0]]).all()
            self.single.append(int(labels[at[0]]) if same else None)
            if len(at) <= LEAF:
                self.below.append(at)
                continue
            self.below.append([])
            wide = int((self.most[-1] - own.min(axis=0)).argmax())
            half = len(at) // 2
            order = np.argpartition(own[:, wide], half)
            open_ += [(at[order[:half]], node), (at[order[half:]], node)]

    def is_leaf(self, node: int) -> bool:
        return not isinstance(self.below[node], list)


def meeting(counts, sizes, labels, others, other_sizes, other_labels, percent: int, same: bool) -> tuple:
    """(i, j, bound) of all points of two leaves that have different labels and may overlap enough."""
    import numpy as np

    bound = np.minimum(counts[:, None, :], others[None, :, :]).sum(axis=2, dtype=np.int64)
    ok = (100 + percent) * bound >= percent * (sizes[:, None] + other_sizes[None, :])
    ok &= labels[:, None] != other_labels[None, :]
    if same:
        ok = np.triu(ok, 1)
    left, right = np.nonzero(ok)
    return left, right, bound[left, right]


def overlapping(a: CountTree, b: CountTree, percent: int) -> Iterator[tuple]:
    """(i, j, bound) arrays of places in ``a`` and ``b`` with different labels whose overlap may be ``percent`` of the union.

    Two sets have no more members in common than the sum, over the coordinates, of the smaller count. For boxes the largest
    counts stand in, so a pair of boxes below the bound holds no pair above it. Within one tree each pair comes once.
    """
    import numpy as np

    open_ = [(0, 0)]
    while open_:
        x, y = open_.pop()
        if a.single[x] is not None and a.single[x] == b.single[y]:
            continue
        most = int(np.minimum(a.most[x], b.most[y]).sum(dtype=np.int64))
        if most * (100 + percent) < percent * (a.least[x] + b.least[y]):
            continue
        if a.is_leaf(x) and b.is_leaf(y):
            i, j = a.below[x], b.below[y]
            left, right, bound = meeting(
                a.counts[i], a.sizes[i], a.labels[i], b.counts[j], b.sizes[j], b.labels[j], percent, a is b and x == y
            )
            if len(left):
                yield i[left], j[right], bound
        elif a is b and x == y:
            p, q = a.below[x]
            open_ += [(p, p), (q, q), (p, q)]
        elif b.is_leaf(y) or (not a.is_leaf(x) and a.least[x] >= b.least[y]):
            open_ += [(p, y) for p in a.below[x]]
        else:
            open_ += [(x, q) for q in b.below[y]]
