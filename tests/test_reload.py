"""Partial reload: equal to a full one, and nothing else is written."""

import os

from conftest import as_set

from ledgerlake.operators import quality
from ledgerlake.operators.landing import land
from ledgerlake.plans import reload
from ledgerlake.sources import tills

HEADER = "bill_no,line_no,product_code,qty,unit_price,line_type,ts\n"


def _export(folder, name, lines):
    rows = "".join(f"{bill},{line},p,{qty},2.00,SALE,t\n" for bill, line, qty in lines)
    (folder / f"SALES_{name}.csv").write_text(HEADER + rows)


def _files(root):
    found = {}
    for path, _, names in os.walk(root / "lake"):
        for name in names:
            if name.endswith(".parquet"):
                found.setdefault(os.path.relpath(path, root), set()).add((name, os.stat(f"{path}/{name}").st_mtime_ns))
    return found


def _check(spark, folder, root):
    full = land(tills.read_tills(spark, str(folder)))
    part = reload.read_reloaded(spark, str(root))
    assert as_set(part, *sorted(full.columns)) == as_set(full, *sorted(full.columns))
    assert part.count() == full.count()
    sums = lambda lines: as_set(reload.partition_checksums(lines, quality.portable_row_hash))
    assert sums(part) == sums(full)


def test_reload(spark, tmp_path):
    folder, root = tmp_path / "tills", tmp_path / "root"
    folder.mkdir()
    _export(folder, "S01_20240105", [("b1", 1, 1), ("b1", 2, 2)])
    _export(folder, "S01_20240205", [("b2", 1, 3), ("b1", 2, 9)])  # loses b1:2 to January
    _export(folder, "S02_20240105", [("b3", 1, 4)])
    _export(folder, "S03_20240105", [("b4", 1, 5)])
    # The other dialects have stores of their own.
    (folder / "SALES_S06_20240105.csv").write_text("bill_no;line_no;item_code;quantity;rate;type;txn_time\nc1;1;p;1;2.00;SALE;t\n")
    (folder / "SALES_S10_20240105.csv").write_text("ts,bill_no,line_no,line_type,product_code,unit_price,qty\n5,d1,1,SALE,p,2.00,1\n")
    run = lambda: as_set(reload.reload(spark, str(folder), str(root)))
    place = lambda store, month: (f"S{store:02d}", 2024, f"{month:02d}")
    path = lambda store, month: f"lake/store_id=S{store:02d}/year=2024/month={month:02d}"
    assert len(run()) == 6
    _check(spark, folder, root)
    # Nothing changed, or only a time: nothing is written.
    before = _files(root)
    assert run() == set() and _files(root) == before
    os.utime(folder / "SALES_S02_20240105.csv", (10**9, 10**9))
    assert run() == set() and _files(root) == before
    # A re-send adds a line and repeats one.
    _export(folder, "S02_20240105__R1", [("b3", 1, 8), ("b3", 2, 6)])
    assert run() == {place(2, 1)}
    _check(spark, folder, root)
    after = _files(root)
    assert {one for one in after if after[one] != before.get(one)} == {path(2, 1)}
    # January loses b1:2, so February's copy lands: its partition is written as well.
    _export(folder, "S01_20240105", [("b1", 1, 1)])
    assert run() == {place(1, 1), place(1, 2)}
    _check(spark, folder, root)
    # A line that another store had first moves there and empties a partition.
    before = _files(root)
    _export(folder, "S02_20240105", [("b3", 1, 4), ("b4", 1, 7)])
    assert run() == {place(2, 1), place(3, 1)}
    _check(spark, folder, root)
    assert path(3, 1) not in _files(root)
    # An export that goes takes its lines along; the next owner gets them back.
    os.remove(folder / "SALES_S02_20240105.csv")
    assert run() == {place(2, 1), place(3, 1)}
    _check(spark, folder, root)
    after = _files(root)
    assert {one for one in before if after.get(one) != before[one]} == {path(2, 1), path(3, 1)}
    os.remove(folder / "SALES_S01_20240205.csv")
    assert run() == {place(1, 2)} and path(1, 2) not in _files(root)
    _check(spark, folder, root)
