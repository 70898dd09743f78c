from tallybook.plans import registry


def test_inputs_of_the_loads_are_built_once(spark, monkeypatch):
    seen = []
    load = registry.landing.load_all

    def watched(store, ticks, transactions, expenses, violating, *rest):
        seen.append([df.inputFiles() for df in (transactions, expenses, violating)])
        return load(store, ticks, transactions, expenses, violating, *rest)

    monkeypatch.setattr(registry.landing, "load_all", watched)
    result = registry.QUERIES["load_all"].run(spark, "/root/testdata/sf0.001").collect()
    assert len(result) == 4 and len(seen) == 2 and seen[0] == seen[1]
    for found, label in zip(seen[0], ("parsed-", "expenses-", "parsed-")):
        assert any(f"/{label}" in f for f in found)
        assert not any("/events.parquet" in f or "/lineitem.parquet" in f for f in found)
