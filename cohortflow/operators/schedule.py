"""Study schedules: which elapsed time belongs to which timepoint."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

class Span(NamedTuple):
    """An inclusive range."""

    low: float
    high: float

    @classmethod
    def read(cls, value, where: str) -> Span:
        try:
            low, high = map(float, value)
        except (TypeError, ValueError):
            raise ValueError(f"{where}: {value!r} is not a pair of numbers") from None
        if low > high:
            raise ValueError(f"{where}: {low:g} lies above {high:g}")
        return cls(low, high)


def read_spans(raw, where: str) -> list[Span]:
    """Spans from any sequence of pairs; nothing gives none."""
    if raw is None:
        return []
    if not isinstance(raw, Sequence) or isinstance(raw, str):
        raise ValueError(f"{where}: expected a list of pairs of numbers, not {raw!r}")
    return [Span.read(value, where) for value in raw]


@dataclass(frozen=True)
class Repeating:
    """A study that calls its participants back at a fixed interval; all values in years.

    The first window starts at the baseline, the second has limits of its own, and every later one
    lies around its due time, the margins wide.
    """

    interval_years: float
    t1_max: float
    t2_min: float
    t2_max: float
    lower_margin: float
    upper_margin: float

    def __post_init__(self):
        if not self.interval_years > 0:
            raise ValueError(f"interval_years has to be positive, not {self.interval_years:g}")
        Span.read((self.t2_min, self.t2_max), "t2_min, t2_max")

    @classmethod
    def read(cls, given: Mapping) -> Repeating:
        wanted = [f.name for f in fields(cls)]
        if lacking := [name for name in wanted if name not in given]:
            raise ValueError(f"The custom schedule lacks {', '.join(lacking)} (or a list of 'windows')")
        return cls(**{name: float(given[name]) for name in wanted})

    def window(self, tp: int) -> Window:
        due = (tp - 1) * self.interval_years
        if tp == 1:
            return Window(1, 0.0, self.t1_max, 0.0, due)
        if tp == 2:
            return Window(2, self.t2_min, self.t2_max, (self.t2_min + self.t2_max) / 2.0, due)
        return Window(tp, due - self.lower_margin, due + self.upper_margin, due, due)


# The two built-in study schedules.
BUILT_IN = {
    "TLSA": Repeating(interval_years=1.0, t1_max=0.74, t2_min=0.75, t2_max=1.50, lower_margin=0.49, upper_margin=0.50),
    "SANSCOG": Repeating(interval_years=2.0, t1_max=1.49, t2_min=1.50, t2_max=3.00, lower_margin=0.90, upper_margin=1.00),
}


@dataclass(frozen=True)
class Window:
    tp: int
    low: float
    high: float
    centre: float
    ideal: float


@dataclass(frozen=True)
class Schedule:
    """Windows in timepoint order; ``repeat`` is the interval of a repeating schedule."""

    windows: tuple[Window, ...]
    repeat: float | None

    def match(self, elapsed: Column) -> Column:
        """The smallest timepoint whose inclusive window holds ``elapsed``, else NULL."""
        return self._by_window(
            lambda w: elapsed.between(F.lit(w.low), F.lit(w.high)), lambda w: F.lit(w.tp)
        ).cast("int")

    def centre(self, tp: Column) -> Column:
        return self._by_window(lambda w: tp == w.tp, lambda w: F.lit(w.centre))

    def ideal(self, tp: Column) -> Column:
        """When the protocol asks for the visit: (n-1) intervals, or the middle of a given window."""
        if self.repeat is not None:
            return (tp - 1).cast("double") * F.lit(self.repeat)
        return self._by_window(lambda w: tp == w.tp, lambda w: F.lit(w.ideal))

    def _by_window(self, test, value) -> Column:
        first, *others = self.windows
        chain = F.when(test(first), value(first))
        for w in others:
            chain = chain.when(test(w), value(w))
        return chain


def build_schedule(scheme: str, custom, max_timepoints: int) -> Schedule:
    """The windows of a built-in scheme, or of a custom one (mapping or JSON text)."""
    if max_timepoints < 1:
        raise ValueError(f"max_timepoints: at least one timepoint is needed, not {max_timepoints}")
    if scheme in BUILT_IN:
        rule = BUILT_IN[scheme]
    elif scheme == "custom":
        given = json.loads(custom) if isinstance(custom, str) and custom.strip() else custom
        if not given or not isinstance(given, Mapping):
            raise ValueError("A custom schedule has to be defined: give custom_windows")
        if "windows" in given:
            spans = read_spans(given["windows"], "windows")[:max_timepoints]
            if not spans:
                raise ValueError("windows: the list is empty")
            middles = [(low + high) / 2.0 for low, high in spans]
            return Schedule(
                tuple(Window(tp, *span, mid, mid) for tp, (span, mid) in enumerate(zip(spans, middles, strict=True), 1)),
                None,
            )
        rule = Repeating.read(given)
    else:
        raise ValueError(f"No schedule is called {scheme!r}; there are {', '.join(sorted(BUILT_IN))} and custom")
    return Schedule(tuple(rule.window(tp) for tp in range(1, max_timepoints + 1)), rule.interval_years)
