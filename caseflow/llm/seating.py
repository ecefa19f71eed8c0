"""Chinese-restaurant seating with a discount, for many dishes at once.

A Gibbs step takes customers of a dish from their tables and seats them anew, given all others. That may be done for
many together: customers who share nothing but new tables have as many ways to do so as the generalised Stirling
numbers tell, and those who join others do it as balls of Polya's urn. So all customers of a dish leave at once;
of a dish with more than ``TOGETHER`` a part leaves at a time, until as many have left as it has.
"""

from __future__ import annotations

from functools import cache

import numpy as np

# Customers that are seated together on new tables, at most.
TOGETHER = 1024
# Of a dish with more, how many times as many leave as stay, and how many of them, on average, are to take new tables.
LEAVE = 3
NEWCOMERS = 256
# Odds of dishes that are in memory at once; customers of dishes whose odds need no logarithms.
_ODDS = 1 << 19
_PLAIN = 24


@cache
def log_ways(discount: float) -> list[np.ndarray]:
    """``[n][t - 1]``: the logarithm of the generalised Stirling number of n customers on t tables, the sum over all
    ways to share them of the product over tables of (1 - discount)(2 - discount) ... (size - 1 - discount)."""
    found = [np.zeros(0), np.zeros(1)]
    for n in range(1, TOGETHER):
        last = found[n]
        joins = np.append(last + np.log(n - discount * np.arange(1, n + 1)), -np.inf)
        opens = np.append(-np.inf, last)
        found.append(np.logaddexp(joins, opens))
    return found


def _reach(n: int, weight: np.ndarray, rise: np.ndarray, discount: float) -> np.ndarray:
    """Odds of at most 1, 2, .. n tables for dishes with ``n`` customers each."""
    further = weight[:, None] + rise[:, None] * np.arange(1, n)
    if n <= _PLAIN:  # far from the largest number there is
        odds = np.empty((len(weight), n))
        odds[:, 0] = 1
        np.cumprod(further, axis=1, out=odds[:, 1:])
        odds *= np.exp(log_ways(discount)[n])
    else:
        odds = np.zeros((len(weight), n))
        np.cumsum(np.log(further), axis=1, out=odds[:, 1:])
        odds += log_ways(discount)[n]
        odds -= odds.max(axis=1, keepdims=True)
        np.exp(odds, out=odds)
    return np.cumsum(odds, axis=1, out=odds)


def _tables(n: int, weight: np.ndarray, rise: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables of dishes with ``n`` customers each, all of whom are seated anew."""
    luck = rng.random(len(weight))
    if (weight == weight[0]).all() and (rise == rise[0]).all():
        reach = _reach(n, weight[:1], rise[:1], discount)[0]
        return np.minimum(1 + np.searchsorted(reach, luck * reach[-1], "right"), n)
    reach = _reach(n, weight, rise, discount)
    return np.minimum(1 + (reach <= (luck * reach[:, -1])[:, None]).sum(axis=1), n)


def shared(n: int, tables: int, discount: float, rng) -> np.ndarray:
    """How ``n`` customers share ``tables`` tables, given their number."""
    ways, opens = log_ways(discount), []
    luck = rng.random((2, n))
    for seated in range(n, 0, -1):
        alone = seated == tables or (tables > 1 and luck[0, seated - 1] < np.exp(ways[seated - 1][tables - 2] - ways[seated][tables - 1]))
        opens.append(alone)
        tables -= alone
    sizes: list[int] = []
    for seated, alone in enumerate(reversed(opens)):
        if alone:
            sizes.append(1)
            continue
        pick, at = luck[1, seated] * (seated - discount * len(sizes)), 0
        while at < len(sizes) - 1 and pick >= sizes[at] - discount:
            pick -= sizes[at] - discount
            at += 1
        sizes[at] += 1
    return np.array(sizes, np.int64)


def _newcomers(weight: float, more: int, joined: float, discount: float, rng) -> int:
    """How many of ``more`` customers go to new tables, if the tables there draw as ``joined`` customers would.

    The odds of m are the ways to choose them, times the ways of the others to join, times all ways of m to share new
    tables. The last, over m!, are the coefficients of exp(weight (1 - (1 - x)^discount) / discount).
    """
    x = more / (joined + more - 1)
    mean = weight * x * (1 - x) ** (discount - 1)
    most = int(min(more, TOGETHER, 2 * mean + 12 * mean**0.5 + 40 + 30 * x / (1 - x)))
    k = np.arange(1, most + 1)
    sizes = np.concatenate([[1], np.cumprod(x * (k - discount) / k)])[::-1]
    odds = np.zeros(most + 1)
    odds[0] = np.exp(-weight * (1 - (1 - x) ** discount) / discount)
    for m in range(most):
        odds[m + 1] = x * weight / (m + 1) * np.dot(sizes[most - m :], odds[: m + 1])
    odds[1:] *= np.cumprod((more - k + 1) / (joined + more - k) / x)
    reach = np.cumsum(odds)
    return int(min(np.searchsorted(reach, rng.random() * reach[-1], "right"), most))


def seat(sizes: np.ndarray, more: int, weight: float, discount: float, rng) -> np.ndarray:
    """Customers by table once ``more`` have been seated together beside those of ``sizes``."""
    alone = _newcomers(weight, more, sizes.sum() - discount * len(sizes), discount, rng)
    if more > alone:
        share = rng.standard_gamma(sizes - discount)
        sizes = sizes + rng.multinomial(more - alone, share / share.sum())
    if not alone:
        return sizes
    tables = int(_tables(alone, np.array([weight]), np.zeros(1), discount, rng)[0])
    return np.concatenate([sizes, shared(alone, tables, discount, rng)])


class Seating:
    """Tables of every dish: a dish of ``customers`` has at least one if any.

    ``weight`` of a dish, in all methods, is what draws a customer to its first table: (strength + discount x tables of
    all other dishes) x probability of the dish in the parent. Every table it has already adds ``rise`` to that. A
    dish of more than ``TOGETHER`` customers makes ``sweeps`` sweeps at a time.
    """

    def __init__(
        self, customers: np.ndarray, discount: float, weight: np.ndarray, rng, sweeps: int = 1, rise: np.ndarray | None = None
    ) -> None:
        self.discount, self.sweeps, self.customers = discount, sweeps, customers
        self._rng = rng
        order = np.argsort(customers, kind="stable")
        ends = np.searchsorted(customers[order], np.arange(1, TOGETHER + 2))
        self._groups = [(n + 1, order[a:b]) for n, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if a < b]
        self._large = {int(i): np.zeros(0, np.int64) for i in order[ends[-1] :]}
        self._number = np.zeros(len(customers), np.int64)
        rise = np.zeros(len(customers)) if rise is None else rise
        for i in self._large:
            self._large[i] = self._first(int(customers[i]), weight[i], rise[i], rng)
        self.sweep(weight, rng, rise)

    def _first(self, customers: int, weight: float, rise: float, rng) -> np.ndarray:
        """A large dish, some of its customers coming at a time. Each table that the first n of N customers have makes
        the ways to seat the others about (n / N) ** discount times as many, so that is what a table counts then."""
        seated = TOGETHER
        less = (seated / customers) ** self.discount
        tables = int(_tables(seated, np.array([weight * less]), np.array([rise * less]), self.discount, rng)[0])
        sizes = shared(seated, tables, self.discount, rng)
        while seated < customers:
            drawn = weight + rise * len(sizes)
            most = max(1, int(NEWCOMERS * seated / (drawn * min(1, ((1 + LEAVE) * seated / customers)) ** self.discount)))
            more = min(customers - seated, LEAVE * seated, most)
            seated += more
            sizes = seat(sizes, more, drawn * (seated / customers) ** self.discount, self.discount, rng)
        return sizes

    def _draw(self, weight: np.ndarray, rise: np.ndarray, rng) -> None:
        for n, dishes in self._groups:
            if n == 1:
                self._number[dishes] = 1
                continue
            step = max(1, _ODDS // n)
            for at in range(0, len(dishes), step):
                some = dishes[at : at + step]
                self._number[some] = _tables(n, weight[some], rise[some], self.discount, rng)

    def sweep(self, weight: np.ndarray, rng, rise: np.ndarray | None = None) -> None:
        """All customers of every dish leave and are seated anew. A new seating has made one sweep."""
        rise = np.zeros(len(self.customers)) if rise is None else rise
        self._draw(weight, rise, rng)
        for i, sizes in self._large.items():
            customers = int(self.customers[i])
            for _ in range(self.sweeps):
                left = customers
                while left:
                    drawn = weight[i] + rise[i] * len(sizes)
                    leave = min(left, customers * LEAVE // (1 + LEAVE), max(1, int(NEWCOMERS * customers / (NEWCOMERS + drawn))))
                    sizes = sizes - rng.multivariate_hypergeometric(sizes, leave, method="marginals")
                    sizes = sizes[sizes > 0]
                    sizes = seat(sizes, leave, weight[i] + rise[i] * len(sizes), self.discount, rng)
                    left -= leave
            self._large[i] = sizes
            self._number[i] = len(sizes)

    def tables(self) -> np.ndarray:
        """Tables of every dish, in the order given."""
        return self._number.copy()

    @property
    def sizes(self) -> np.ndarray:
        """Customers by table, dish after dish."""
        each = [
            self._large[i] if i in self._large else shared(int(n), int(t), self.discount, self._rng)
            for i, (n, t) in enumerate(zip(self.customers, self._number, strict=True))
        ]
        return np.concatenate(each) if each else np.zeros(0, np.int64)
