import random

from pyspark.sql import functions as F

from tidemark.operators import delta, embed, retrieve
from tidemark.operators.known import KnownValues
from tidemark.operators.store import ChunkStore
from tidemark.plans.config import FilterRequest, MetadataField, RetrievalConfig
from tidemark.plans.ingest import Plan, run
from tidemark.plans.search import search
from tidemark.sources import scan


def test_view_follows_replaces_and_deletes(spark, tmp_path):
    kind = "tenant_id string, repo_id string, source_id string, chunk_index int, app string, level string"
    store, view, r = ChunkStore(spark, str(tmp_path / "s")), KnownValues(spark, str(tmp_path / "k"), ["app", "level", "absent"], fold_every=3), random.Random(2)
    rows = lambda docs: spark.createDataFrame([("t", r.choice("ab"), str(s), i, r.choice(["Alpha One", "Beta", "Γάμμα-Delta", None, "Long Name Here", "x"]), f"l{r.randint(0, 30)}") for s in docs for i in range(2)], kind)
    for n in range(5):
        new = rows(range(n * 3, n * 3 + 9)).persist()
        gone = spark.createDataFrame([("t", x, str(n * 2)) for x in "ab"], "tenant_id string, repo_id string, source_id string")
        keys, before = new.select(*delta.KEYS).union(gone).distinct(), store.read()
        old = None if before is None else before.join(keys, delta.KEYS, "left_semi").persist()
        if old is not None:
            old.count()
        store.replace(new, gone)
        view.update(new, old)
        live = store.read()
        assert sorted(map(str, view.values().collect())) == sorted(map(str, retrieve.known_values(live, ["app", "level"]).collect()))
        for question in ("what of alpha one?", "AO and LNH", "γάμμα delta, l3 or l30", "nothing", "beta long name"):
            assert view.named(question, ["app", "level"]) == retrieve.named_values(live, ["app", "level"], question)
    assert {x.value for x in view.values("t", ["a"]).where("field = 'app'").collect()} == {x.app for x in store.read("t", "a").select("app").distinct().collect()} - {None}
    plan = view.values()._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "s") not in plan and [n for n, x in view._known() if x.endswith("-whole")] == [2]
    assert view.named("", ["app"]) == {} and view.values("u").count() == 0


def test_a_run_keeps_the_view_and_a_search_uses_it(spark, tmp_path):
    folder = tmp_path / "files"
    for name, text in (("Alpha One/a.md", "apples"), ("Beta/b.md", "pears")):
        (folder / name).parent.mkdir(parents=True)
        (folder / name).write_text(text)
    view, store = KnownValues(spark, str(tmp_path / "k"), ["app"]), ChunkStore(spark, str(tmp_path / "s"))
    plan = Plan("t", "r", schema=[MetadataField("app", "path_segment", 0)], provider=embed.HashingProvider(dimensions=8), known=view)
    reg, _ = run(scan.scan(spark, "local", {"path": str(folder)}), spark.createDataFrame([], delta.REGISTRY), store, plan, "j1", F.lit("2024-01-01").cast("timestamp"))
    assert {x.value for x in view.values().collect()} == {"Alpha One", "Beta"}
    found = search(store.read(), "t", {"r": RetrievalConfig(filterable_fields=("app",))}, "what does AO say?", plan.provider, 5, FilterRequest(auto_extract=True), known=view)
    assert {x.app for x in found.collect()} == {"Alpha One"}
    (folder / "Beta" / "b.md").unlink()
    run(scan.scan(spark, "local", {"path": str(folder)}), reg, store, plan, "j2", F.lit("2024-01-01").cast("timestamp"))
    assert {x.value for x in view.values().collect()} == {"Alpha One"}
