import os

import pytest

from tidemark.sources import scan


@pytest.mark.parametrize("recursive", [True, False])
def test_listing_in_tasks_equals_that_of_the_driver(spark, tmp_path, monkeypatch, recursive):
    root = tmp_path / "root"
    for folder in ("a/b/c/d", "a/e", "f g/ü", ".hidden/x", "_under"):
        (root / folder).mkdir(parents=True)
        for name in ("one.md", "two.TXT", ".dot.md", "~$lock.md", "big.md", "skip.tmp", "no_extension"):
            (root / folder / name).write_text("x" * (900 if name == "big.md" else 3) + folder)
    (root / "top.md").write_text("top")
    os.symlink(root / "a", root / "linked")
    os.symlink(root / "top.md", root / "also.md")
    os.symlink(root / "nowhere", root / "broken.md")
    cfg = {"path": str(root), "max_bytes": 500, "recursive": recursive}
    feed = lambda: sorted((x.source_id, bytes(x.content), x.content_hash) for x in scan.scan(spark, "local", cfg).collect())
    plain = feed()
    want = [f[len(str(root)) :] for d, below, files in os.walk(root) for f in (os.path.join(d, n) for n in files) if os.path.exists(f) and os.stat(f).st_size <= 500 and not os.path.basename(f).startswith((".", "~$")) and not f.endswith(".tmp") and (recursive or d == str(root))]
    assert [x for x, _, _ in plain] == sorted(want) and "/also.md" in want
    for few in (0, 3, 9):
        monkeypatch.setattr(scan, "DRIVER_NAMES", few)
        assert feed() == plain
    assert scan.scan(spark, "local", {"path": str(tmp_path / "missing")}).count() == 0
