"""Steps of a retrieval batch are made for the keys that ask for them."""

from skein.operators import graph as gr


def test_steps_are_made_when_asked_for(spark):
    nodes = spark.createDataFrame([("a", "alpha", "person", "red fox", "m"), ("b", "beta", "place", "blue fox", None), ("c", "gamma", "place", None, "n")],
                                  "node_id string, name string, labeled string, description string, metadata string")
    edges = spark.createDataFrame([("e1", "a", "b", "follows", "green bird"), ("e2", "b", "c", "cites", "grey bird")],
                                  "edge_id string, src_id string, dst_id string, rel_type string, description string")
    prompts = spark.createDataFrame([(1, "green bird"), (2, "fox")], "prompt_id long, prompt string")
    g = gr.GraphRetrieval.run(prompts, nodes, edges)
    made = lambda: {"node_rows", "endpoints", "hoods"} & set(vars(g))
    assert made() == set()
    assert {(r.item_id, r.endpoint_id) for r in g.endpoints.where("prompt_id = 1").collect()} >= {("e1", "a"), ("e1", "b")}
    assert made() == {"endpoints"}  # no neighbourhood of a hub is built for the ends alone
    assert {(r.item_id, r.neighbor_id) for r in g.node_rows.where("prompt_id = 2").collect()} == {("a", "b"), ("b", "a"), ("b", "c")}
    assert g.hoods is g.hoods and {(r.endpoint_id, r.neighbor_id) for r in g.hoods.where("prompt_id = 1").collect()} >= {("a", "b"), ("b", "a")}
