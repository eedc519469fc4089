import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from feedloom.operators import hierarchy as hi
from feedloom.sources.snapshots import roster_snapshot


def paths(spark, parents, max_steps=None):
    nodes = spark.createDataFrame(list(parents.items()), "id string, parent_id string")
    nodes = nodes.withColumn("step", F.struct("id", F.col("id").alias("name")))
    found = hi.ancestor_paths(nodes, max_steps)
    return {r["id"]: "".join(s["id"] for s in r["path"]) for r in found.collect()}


def test_paths_end_at_roots_missing_parents_and_repeats(spark):
    found = paths(spark, {"a": None, "b": "a", "c": "b", "d": "gone", "x": "y", "y": "z", "z": "x", "w": "x", "s": "s"})
    assert found == {
        "a": "a", "b": "ba", "c": "cba", "d": "d", "x": "xyz", "y": "yzx", "z": "zxy", "w": "wxyz", "s": "s",
    }


def test_hot_parent(spark, hot):
    found = paths(spark, {"r": None, "m": "r", **{f"n{i}": "m" for i in range(40)}})
    assert found["n7"] == "n7mr" and len(found) == 42


def long_chain(n):
    return {i: i + 1 if i < n else None for i in range(1, n + 1)}


def test_deep_chain_takes_few_rounds(spark):
    nodes = spark.createDataFrame([(str(i), None if p is None else str(p)) for i, p in long_chain(70).items()], "id string, parent_id string")
    found = hi.ancestor_paths(nodes.withColumn("step", F.struct("id")))
    sizes = {int(r["id"]): len(r["path"]) for r in found.collect()}
    assert sizes == {i: 71 - i for i in range(1, 71)}


def test_rounds_store_few_steps(spark, monkeypatch):
    stored = []

    def counted(df, real=hi.cut):
        kept = real(df)
        stored.append(kept.agg(F.sum(F.size("path"))).first()[0] if "path" in kept.columns else 0)
        return kept

    monkeypatch.setattr(hi, "cut", counted)
    parents = {f"n{i}": f"n{i + 1}" if i % 150 else None for i in range(1, 601)}
    nodes = spark.createDataFrame(list(parents.items()), "id string, parent_id string").withColumn("step", F.struct("id"))
    found = {r["id"]: r["n"] for r in hi.ancestor_paths(nodes).select("id", F.size("path").alias("n")).collect()}
    assert found == {f"n{i}": 151 - (i % 150 or 150) for i in range(1, 601)}
    # All paths have 45,300 steps.
    assert sum(x or 0 for x in stored) < sum(found.values())


def test_stretches_end_alike_on_trees_and_long_cycles(spark):
    parents = {str(i): str((i * 7 + 3) % 60) for i in range(60)} | {str(i): str(i // 2 + 40) for i in range(60, 200)} | {"200": "gone"}
    expected = {}
    for start in parents:
        walk, node = [], start
        while node in parents and node not in walk:
            walk.append(node)
            node = parents[node]
        expected[start] = "".join(walk)
    assert paths(spark, parents) == expected


# ------------------------------------------------------------ self-derived

AGENT = "pol_no string, agt_code string, writing_split string, agt_first_name string, agt_last_name string, upline string, first_seen_at timestamp, row_hash string"


def self_paths(spark, *items):
    """(policy, agent, first, last, upline)."""
    data = [(p, a, "1", f, l, u, None, f"h{i:04d}") for i, (p, a, f, l, u) in enumerate(items)]
    df = spark.createDataFrame(data, AGENT).withColumn("first_seen_at", F.timestamp_seconds(F.lit(0)))
    return {
        r["row_hash"]: [(s["depth"], s["name"], s["writing_number"], s["is_person"]) for s in json.loads(r["roster_hierarchy_json"])]
        for r in hi.self_hierarchy(df).collect()
    }


def test_names_fall_back_to_the_parsed_name_then_the_code(spark):
    found = self_paths(
        spark, ("p1", "1", "Ann", None, "Bob B - 2"), ("p2", "2", " ", "", "Cy - 3"), ("p3", "4", "D", "D", "- 9"),
    )
    assert found["h0000"] == [("01", "Cy", "3", True), ("02", "Bob B", "2", True)]
    assert found["h0001"] == [("01", "Cy", "3", True)]
    assert found["h0002"] == [("01", "9", "9", True)]


def test_own_code_and_unreadable_uplines_give_nothing(spark):
    assert self_paths(spark, ("p1", "1", "A", "A", "A A - 1"), ("p2", "2", "B", "B", "nobody"), ("p3", "3", "C", "C", None)) == {}


def test_cycles_stop_before_the_policys_own_agent(spark):
    found = self_paths(spark, ("p1", "1", "A", None, "B - 2"), ("p2", "2", "B", None, "C - 3"), ("p3", "3", "C", None, "A - 1"))
    assert [s[2] for s in found["h0000"]] == ["3", "2"]
    assert [s[2] for s in found["h0001"]] == ["1", "3"]


def test_blank_own_code_has_nobody_to_avoid(spark):
    found = self_paths(spark, ("p1", " ", None, None, "B - 2"), ("p2", "2", "B", None, "C - 3"), ("p3", "3", "C", None, "B - 2"))
    assert [s[2] for s in found["h0000"]] == ["3", "2"]


def test_long_chains_are_listed_in_full(spark):
    found = self_paths(spark, *[(f"p{i}", str(1000 + i), f"N{i}", None, f"up - {1001 + i}") for i in range(104)])
    first = found["h0000"]
    assert [s[2] for s in first] == [str(n) for n in range(1104, 1000, -1)]
    assert [s[0] for s in first] == [f"{n:02d}" for n in range(1, 105)]


# ---------------------------------------------------------------- roster

def roster(spark):
    def frame(data, schema):
        return spark.createDataFrame(data, schema)

    return roster_snapshot({
        "roster_agent": frame([("a1", "Al", "Ag", "n")], "id string, first_name string, last_name string, national_producer_number string"),
        "roster_carrier": frame([("c1", "The UNL Company"), ("c2", "Other")], "id string, name string"),
        "roster_agency": frame([("g1", "Top", False), ("g2", None, True), ("g3", "Low", True)], "id string, name string, is_person boolean"),
        "roster_agencycarrier": frame(
            [("k1", "g1", "c1", "100", None), ("k2", "g2", "c1", " 200 ", "k1"), ("k3", "g3", "c1", "300", "k2"),
             ("k4", "g3", "c2", "400", "k1"), ("k5", "missing", "c1", "500", "k1"),
             ("k6", "g1", "c1", "600", "k7"), ("k7", "g3", "c1", "700", "k6")],
            "id string, agency_id string, carrier_id string, writing_number string, parent_id string",
        ).selectExpr("*", "'' AS status", "null AS start", "null AS end"),
        "roster_agentcarrier": frame(
            [("x1", "a1", "c1", "900"), ("x2", "a1", "c1", "300")], "id string, agent_id string, carrier_id string, writing_number string"
        ).selectExpr("*", "'' AS status", "null AS start", "null AS end"),
        "roster_agentagency": frame(
            [("l1", "a1", "k2", "2026-01-01", "2026-01-01 00:00:00"), ("l2", "a1", "k1", "2026-01-01", "2026-01-02 00:00:00"),
             ("l3", "a1", "k3", None, "2026-09-09 00:00:00"), ("l4", "a1", "k4", "2026-09-09", None)],
            "id string, agent_id string, agency_carrier_id string, start string, created string",
        ).selectExpr("*", "'' AS status", "null AS end"),
    })


@pytest.mark.parametrize("levels, names", [
    (("100", None, None), ["Top"]),
    (("100", "200", " "), ["Top", None]),          # deepest level wins, blanks do not count
    (("100", " 300 ", None), ["Top", None, "Low"]),  # the agency's own number beats the agent's
    (("900", None, None), ["Top"]),                # agent link: newest start, then created
    (("400", None, None), None),                   # another carrier
    (("100", "500", None), None),                  # the appointment has no agency
    (("600", None, None), ["Low", "Top"]),         # two appointments above each other
    ((None, None, None), None),
])
def test_roster_hierarchy(spark, levels, names):
    df = spark.createDataFrame([("r1", *levels)], "row_id string, l1 string, l2 string, l3 string")
    found = rows(hi.roster_hierarchy(df, roster(spark), "%unl%", ["l1", "l2", "l3"]))
    if names is None:
        assert found == []
    else:
        steps = json.loads(found[0][1])
        assert [s["name"] for s in steps] == names
        assert [s["depth"] for s in steps] == [f"{i:02d}" for i in range(1, len(names) + 1)]
        assert all(set(s) == {"depth", "name", "writing_number", "is_person"} for s in steps)
