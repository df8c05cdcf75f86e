"""State operators take a key's rows piece by piece and never hold them all."""

import random

import pandas as pd
import pytest

from marinelake.streaming import state
from marinelake.streaming.sequences import HeaderInForce, Preamble
from marinelake.streaming.state import Changed, MinGap
from tests.test_live import Store, scan_line

SIZE = 50


@pytest.fixture(autouse=True)
def small_memory(monkeypatch):
    """Pieces go to the local file."""
    monkeypatch.setattr(state, "IN_MEMORY", 1000)


def given(processor, rows, seed=0):
    """What a processor gives for rows in pieces in any order, none larger than a piece."""
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    pieces = [pd.DataFrame(rows[i : i + SIZE]) for i in range(0, len(rows), SIZE)]
    parts = list(processor.handleInputRows(("k",), iter(pieces), None))
    assert max(map(len, parts), default=0) <= SIZE
    return [r for part in parts for r in part.to_dict("records")]


def test_scans_of_many_pieces():
    lines = ["noise", *["A"] * 700, "* head", "# XMLCON_START", "# <a>", "# XMLCON_END", *["A"] * 300, "# XMLCON_START", "# <b>", *["A"] * 5]
    processor = Preamble("value", ["source_file", "line_ord", "value"])
    processor.init(Store())
    rows = given(processor, [scan_line(i, v) for i, v in enumerate(lines)])
    scans = sorted((r["line_ord"], r["scan"], r["version"]) for r in rows if r["role"] == "scan")
    at = [i for i, v in enumerate(lines) if v == "A"]
    assert scans == [(i, n, 0 if n <= 700 else 1 if n <= 1000 else 2) for n, i in enumerate(at, 1)]
    assert {r["version"]: r["xmlcon"] for r in rows if r["role"] == "preamble"} == {1: "<a>\n", 2: "<b>\n"}
    # Two scans with one place both have a number.
    again = given(processor, [scan_line(i, "A") for i in (5000, 5000, 5001)])
    assert sorted(r["scan"] for r in again) == [1006, 1007, 1008] and {r["version"] for r in again} == {2}


def test_headers_of_many_pieces():
    processor = HeaderInForce("value", ["line_ord", "value"], 120)
    processor.init(Store())

    def lines(start, stop):
        return [{"line_ord": i, "value": f"h{i}" if i in (300, 500) else "v", "state_order": i, "state_mark": i in (300, 500)} for i in range(start, stop)]

    assert given(processor, lines(0, 40)) == []
    rows = given(processor, lines(40, 900), 1)
    assert sorted((r["line_ord"], r["header"]) for r in rows) == [(i, "h300" if i < 500 else "h500") for i in range(900) if i not in (300, 500)]


def test_gap_and_change_of_many_pieces():
    rng = random.Random(3)
    rows = [{"n": i, "state_time_us": rng.randrange(300), "state_order": i, "state_force": rng.random() < 0.05} for i in range(600)]
    kept, last = [], None
    for r in sorted(rows, key=lambda r: (r["state_time_us"], r["state_order"])):
        if r["state_force"] or last is None or r["state_time_us"] - last >= 7:
            kept.append(r["n"])
            last = r["state_time_us"]
    gap, changed = MinGap(7), Changed()
    for processor in (gap, changed):
        processor.init(Store())
    assert sorted(r["n"] for r in given(gap, rows)) == sorted(kept) and gap._read() == last
    expected = [r["n"] for before, r in zip([None, *rows], rows) if before is None or before["state_time_us"] != r["state_time_us"]]
    assert sorted(r["n"] for r in given(changed, rows)) == expected
    # The first row of the next micro-batch is compared with the last of this one.
    assert given(changed, [{**rows[-1], "n": 600, "state_order": 600}]) == []
