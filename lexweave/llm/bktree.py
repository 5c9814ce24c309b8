"""A BK-tree under the Levenshtein distance, a true metric, and shards of such trees."""

from __future__ import annotations

from collections.abc import Iterable


def pattern(a: str) -> dict[str, int]:
    """The places of each character of a text, as bits."""
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    return places


def distance(a: str, b: str, places: dict[str, int] | None = None, most: int | None = None) -> int:
    """Levenshtein distance by bit vectors: one step of whole-number arithmetic per character of b.

    ``places`` is a's pattern, where it is known. A distance above ``most`` may come out as any number above it.
    """
    if not a or not b:
        return len(a) + len(b)
    places = pattern(a) if places is None else places
    full, top, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down, left = full, 0, len(b)
    stop = len(a) + len(b) if most is None else most
    for c in b:
        here = places.get(c, 0)
        x = here | down
        diagonal = (((x & up) + up) ^ up) | x
        grow, fall = down | (~(diagonal | up) & full), up & diagonal
        left -= 1
        if grow & top:
            score += 1
        elif fall & top:
            score -= 1
        if score - left > stop:
            return score - left
        grow, fall = (grow << 1 | 1) & full, fall << 1 & full
        seen = here | down
        up, down = fall | (~(seen | grow) & full), grow & seen
    return score


class BKTree:
    """Entries at their distances from a root; |d(q, x) - d(x, y)| <= d(q, y) prunes the search."""

    def __init__(self, entries: Iterable[str] = ()):
        self.root: tuple[str, dict] | None = None
        for e in entries:
            self.add(e)

    def add(self, entry: str) -> None:
        if self.root is None:
            self.root = (entry, {})
            return
        node = self.root
        while (d := distance(node[0], entry)) > 0:
            if d not in node[1]:
                node[1][d] = (entry, {})
                return
            node = node[1][d]

    def within(self, query: str, radius: int) -> list[tuple[int, str]]:
        """Every entry within the radius, with its distance."""
        found, work, places = [], [self.root] if self.root else [], pattern(query)
        while work:
            entry, below = work.pop()
            # Farther than this, neither the entry nor anything below it is within.
            d = distance(query, entry, places, radius + max(below, default=0))
            if d <= radius:
                found.append((d, entry))
            work.extend(node for k, node in below.items() if d - radius <= k <= d + radius)
        return found


class Shards:
    """Trees per band of lengths: a band whose lengths are all too far from the query's holds nothing within."""

    def __init__(self, entries: Iterable[str], band: int = 6):
        self.band, self.entries = band, set(entries)
        self.bands: dict[int, list[str]] = {}
        self.trees: dict[int, BKTree] = {}
        for e in sorted(self.entries):
            self.bands.setdefault(len(e) // band, []).append(e)

    def _tree(self, k: int) -> BKTree:
        """A band's tree, built when it is first asked."""
        if k not in self.trees:
            self.trees[k] = BKTree(self.bands[k])
        return self.trees[k]

    def within(self, query: str, radius: int) -> list[tuple[int, str]]:
        if radius <= 0:  # only the entry itself
            return [(0, query)] if query in self.entries else []
        near = range((len(query) - radius) // self.band, (len(query) + radius) // self.band + 1)
        return sorted(x for k in near if k in self.bands for x in self._tree(k).within(query, radius))
