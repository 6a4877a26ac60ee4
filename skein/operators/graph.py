"""Graph context from cut full-text hits.

Inputs are ``nodes(node_id, name, labeled, description, metadata)`` and
directed ``edges(edge_id, src_id, dst_id, rel_type, description)``; matching
is undirected. The cut hits are small (at most 40 per prompt and kind), so
every join below is small side ⋈ graph table on an id, which AQE turns into a
broadcast at run time when the hit side is small and splits otherwise; hub
nodes therefore never concentrate work in one task. Expansion carries ids only;
texts are fetched once per distinct text of a prompt. Lists of the reference
are kept as long rows; only the final text per prompt is assembled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.ordering import with_row_index
from skein.operators import fulltext as ft
from skein.session import cut_lineage

# Neighbour labels excluded from the relationship expansion.
EXCLUDED_LABELS = ("event", "organization")

# Rendering.
NODES_HEADING = "*** Nodes:"
RELATIONS_HEADING = "*** Relationships"
ITEM_RULE = "-----"

# Characters of a line that range boundaries look at.
BOUNDARY_CHARS = 128

_PROPS = ("name", "labeled", "description", "metadata")


def node_defaults(nodes: DataFrame) -> DataFrame:
    """Missing properties become ''."""
    return nodes.select("node_id", *[F.coalesce(F.col(p), F.lit("")).alias(p) for p in _PROPS])


def adjacency(edges: DataFrame) -> DataFrame:
    """Undirected view: (node_id, edge_id, other_id, rel_type), without texts.

    A self-loop appears once, parallel edges once each.
    """
    fwd = edges.select(F.col("src_id").alias("node_id"), "edge_id",
                       F.col("dst_id").alias("other_id"), "rel_type")
    rev = edges.where(F.col("src_id") != F.col("dst_id")).select(
        F.col("dst_id").alias("node_id"), "edge_id", F.col("src_id").alias("other_id"), "rel_type")
    return fwd.unionByName(rev)


def _hits(kept: DataFrame, kind: str) -> DataFrame:
    return kept.where(F.col("kind") == kind).select(
        "prompt_id", "item_id", "score", "max_score", "threshold", "relative_score")


def neighbors_inner(node_hits: DataFrame, adj: DataFrame) -> DataFrame:
    """Hit node ⋈ its relationships; isolated hits vanish."""
    return node_hits.join(adj, node_hits.item_id == adj.node_id, "inner").select(
        "prompt_id", "item_id", "score", "edge_id", F.col("other_id").alias("neighbor_id"), "rel_type")


def node_connections(conn: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The connections of each hit node as records (one row per connection):
    the other node and the relationship's type and description, the neighbour's
    metadata. A list per hit is never collected."""
    e = edges.select("edge_id", F.coalesce("description", F.lit("")).alias("description"))
    n = nodes.select(F.col("node_id").alias("neighbor_id"), F.coalesce("name", F.lit("")).alias("neighbor_name"),
                     F.coalesce("metadata", F.lit("")).alias("neighbor_metadata"))
    return conn.join(e, "edge_id").join(n, "neighbor_id", "left").select(
        "prompt_id", "item_id", "edge_id", "neighbor_id", "neighbor_name", "rel_type", "description", "neighbor_metadata")


def edge_endpoints(edge_hits: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Start and end node of each hit relationship, with their properties."""
    e = edge_hits.join(edges, edge_hits.item_id == edges.edge_id, "inner")
    s = nodes.select(F.col("node_id").alias("src_id"),
                     *[F.col(p).alias("start_" + p) for p in _PROPS])
    t = nodes.select(F.col("node_id").alias("dst_id"),
                     *[F.col(p).alias("end_" + p) for p in _PROPS])
    return e.join(s, "src_id", "left").join(t, "dst_id", "left")


def edge_endpoint_set(edge_hits: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per (hit relationship, distinct endpoint); ids only."""
    e = edge_hits.join(edges.select("edge_id", "src_id", "dst_id"), edge_hits.item_id == edges.edge_id, "inner")
    return e.select("prompt_id", "item_id", "score", "src_id", "dst_id",
                    F.explode(F.array_distinct(F.array("src_id", "dst_id"))).alias("endpoint_id"))


def neighborhoods(endpoints: DataFrame, adj: DataFrame, nodes: DataFrame,
                  excluded: tuple = EXCLUDED_LABELS) -> DataFrame:
    """(prompt_id, endpoint_id, nb_edge_id, neighbor_id): the allowed neighbours of each endpoint,
    once per prompt however many hits touch it (a hub's neighbourhood is not repeated per hit).

    Neither endpoint nor neighbour may carry an excluded label (a missing label fails the test).
    Endpoints are joined with the adjacency first and labels are looked up for what that leaves,
    so the whole adjacency never meets the node table.
    """
    def allowed(c):
        cond = c.isNotNull()
        for label in excluded:
            cond = cond & (c != F.lit(label))
        return cond

    lab = nodes.where(allowed(F.col("labeled"))).select("node_id")
    start = endpoints.select("prompt_id", "endpoint_id").distinct().join(lab.withColumnRenamed("node_id", "endpoint_id"), "endpoint_id", "left_semi")
    nb = adj.select(F.col("node_id").alias("endpoint_id"), F.col("edge_id").alias("nb_edge_id"), F.col("other_id").alias("neighbor_id"))
    met = start.join(nb, "endpoint_id").where(F.col("neighbor_id") != F.col("endpoint_id"))
    return met.join(lab.withColumnRenamed("node_id", "neighbor_id"), "neighbor_id", "left_semi") \
              .select("prompt_id", "endpoint_id", "nb_edge_id", "neighbor_id")


def last_hits(endpoints: DataFrame) -> DataFrame:
    """(prompt_id, endpoint_id, other_end, last, but_one): what an endpoint's hits mean for any
    neighbour. A hit shows all neighbours but its own other end. ``last`` is the last hit in write
    order (score descending, then item) and ``other_end`` its other end; ``but_one`` is the last of
    the hits with another other end (NULL without one). So the neighbour ``other_end`` was last
    written by ``but_one`` and every other one by ``last``. One row per (prompt, endpoint)."""
    other = F.when(F.col("endpoint_id") == F.col("src_id"), F.col("dst_id")).otherwise(F.col("src_id"))
    per_end = endpoints.groupBy("prompt_id", "endpoint_id", other.alias("other_end")) \
                       .agg(F.max(F.struct((-F.col("score")).alias("neg_score"), "item_id")).alias("hit"))
    w = Window.partitionBy("prompt_id", "endpoint_id").orderBy(F.desc("hit"))
    two = per_end.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= 2)
    return two.groupBy("prompt_id", "endpoint_id").agg(F.max(F.when(F.col("_r") == 1, F.col("other_end"))).alias("other_end"),
                                                       F.max(F.when(F.col("_r") == 1, F.col("hit"))).alias("last"),
                                                       F.max(F.when(F.col("_r") == 2, F.col("hit"))).alias("but_one"))


def shown_neighbors(hoods: DataFrame, endpoints: DataFrame) -> DataFrame:
    """``hoods`` rows that some hit shows, with the last such hit (score, item_id)."""
    seen = hoods.join(last_hits(endpoints), ["prompt_id", "endpoint_id"])
    hit = F.when(F.col("neighbor_id") == F.col("other_end"), F.col("but_one")).otherwise(F.col("last"))
    return seen.withColumn("hit", hit).where(F.col("hit").isNotNull()).select(
        "prompt_id", "endpoint_id", "nb_edge_id", "neighbor_id", (-F.col("hit.neg_score")).alias("score"), F.col("hit.item_id").alias("item_id"))


def per_hit(endpoints: DataFrame, hoods: DataFrame) -> DataFrame:
    """B14 as the reference returns it: each hit's endpoint with each neighbour that is no end of
    the hit; an endpoint without one stays with NULL neighbour columns. This is the product of
    hits and neighbourhoods, built only for outputs that are per hit."""
    met = endpoints.join(hoods, ["prompt_id", "endpoint_id"]).where((F.col("neighbor_id") != F.col("src_id")) & (F.col("neighbor_id") != F.col("dst_id")))
    found = met.select("prompt_id", "item_id", "endpoint_id", "nb_edge_id", "neighbor_id")
    return endpoints.join(found, ["prompt_id", "item_id", "endpoint_id"], "left")


def neighbors_optional(endpoints: DataFrame, adj: DataFrame, nodes: DataFrame,
                       excluded: tuple = EXCLUDED_LABELS) -> DataFrame:
    """Optional expansion of every endpoint of every hit; ids only."""
    return per_hit(endpoints, neighborhoods(endpoints, adj, nodes, excluded))


def edge_expansion(expanded: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The expansion of each (hit relationship, endpoint) as records: the
    neighbour's name, label and metadata and the additional relationship's type
    and description; an endpoint without expansion keeps one row of NULLs."""
    e = edges.select(F.col("edge_id").alias("nb_edge_id"), F.col("rel_type").alias("nb_type"), F.coalesce("description", F.lit("")).alias("nb_description"))
    n = nodes.select(F.col("node_id").alias("neighbor_id"), F.coalesce("name", F.lit("")).alias("neighbor_name"),
                     F.coalesce("labeled", F.lit("")).alias("neighbor_labeled"), F.coalesce("metadata", F.lit("")).alias("neighbor_metadata"))
    return expanded.join(e, "nb_edge_id", "left").join(n, "neighbor_id", "left").select(
        "prompt_id", "item_id", "endpoint_id", "nb_edge_id", "nb_type", "nb_description", "neighbor_id", "neighbor_name",
        "neighbor_labeled", "neighbor_metadata")


@dataclass
class GraphRetrieval:
    """All intermediate tables of one batch of prompts, each made when first asked for."""
    kept: DataFrame          # B9 output, both kinds
    nodes: DataFrame         # B17 defaults applied, all nodes
    edges: DataFrame
    raw_nodes: DataFrame
    materialize: bool = True

    @classmethod
    def run(cls, prompts: DataFrame, nodes: DataFrame, edges: DataFrame,
            index: ft.FullTextIndex | None = None, top_k: int = ft.TOP_HITS,
            std_multiplier: float = 1.0, materialize: bool = True) -> "GraphRetrieval":
        """Build the batch. With ``materialize`` the small per-batch tables (cut
        hits and their expansions) are checkpointed to the shared folder once,
        so the many branches that read them do not recompute the search."""
        index = index or ft.FullTextIndex.build(nodes, edges)
        kept = ft.kept_hits(prompts, index, top_k, std_multiplier)
        return cls(cut_lineage(kept) if materialize else kept, node_defaults(nodes), edges, nodes, materialize)

    def _keep(self, df: DataFrame) -> DataFrame:
        return cut_lineage(df) if self.materialize else df

    # Ids only: no step below carries a text, whatever the degree of a node.
    @cached_property
    def node_rows(self) -> DataFrame:
        """B10 (query 1 result rows, long form)."""
        return self._keep(neighbors_inner(_hits(self.kept, ft.NODE), adjacency(self.edges)))

    @cached_property
    def endpoints(self) -> DataFrame:
        """B13."""
        return self._keep(edge_endpoint_set(_hits(self.kept, ft.EDGE), self.edges))

    @cached_property
    def hoods(self) -> DataFrame:
        """Neighbourhoods of the endpoints, once per prompt."""
        return self._keep(neighborhoods(self.endpoints, adjacency(self.edges), self.raw_nodes))

    @property
    def expansion(self) -> DataFrame:
        """B14, multiplied out per hit."""
        return per_hit(self.endpoints, self.hoods)

    # ---- B16
    def result_rows(self) -> DataFrame:
        """Rows the two graph queries return, deduplicated, ranked by score."""
        q1 = self.node_rows.select("prompt_id", F.lit(ft.NODE).alias("kind"), "item_id", "score")
        q2 = self.endpoints.select("prompt_id", F.lit(ft.EDGE).alias("kind"), "item_id", "score")
        rows = q1.unionByName(q2).dropDuplicates()
        kept = self.kept.select("prompt_id", "kind", "item_id", "relative_score", "max_score",
                                "threshold")
        return rows.join(kept, ["prompt_id", "kind", "item_id"], "inner")

    # ---- node occurrences in the reference's write order
    def node_occurrences(self) -> DataFrame:
        """(prompt_id, node_id, phase, score, item_id, role) for every node the
        reference reads from the two result sets."""
        q1_hit = self.node_rows.select("prompt_id", F.col("item_id").alias("node_id"),
                                       F.lit(1).alias("phase"), "score", "item_id",
                                       F.lit(0).alias("role")).distinct()
        q1_conn = self.node_rows.select("prompt_id", F.col("neighbor_id").alias("node_id"),
                                        F.lit(1).alias("phase"), "score", "item_id",
                                        F.lit(1).alias("role"))
        q2_start = self.endpoints.select("prompt_id", F.col("src_id").alias("node_id"),
                                         F.lit(2).alias("phase"), "score", "item_id",
                                         F.lit(0).alias("role"))
        q2_end = self.endpoints.select("prompt_id", F.col("dst_id").alias("node_id"),
                                       F.lit(2).alias("phase"), "score", "item_id",
                                       F.lit(1).alias("role"))
        # of the hits that show a neighbour the last one stands for all: every reader takes
        # either distinct nodes or the last write
        q2_nb = shown_neighbors(self.hoods, self.endpoints).select(
            "prompt_id", F.col("neighbor_id").alias("node_id"), F.lit(2).alias("phase"),
            "score", "item_id", F.lit(2).alias("role"))
        occ = q1_hit.unionByName(q1_conn).unionByName(q2_start).unionByName(q2_end) \
                    .unionByName(q2_nb)
        return occ

    def _fetched(self, ids: DataFrame, id_col: str, rows: DataFrame, parts: list[str], text: str) -> DataFrame:
        """Distinct (prompt_id, parts, text) of the rows with the given ids: made
        distinct by a digest of the text, so each text is fetched once."""
        digest = rows.select(id_col, *parts, F.md5(F.col(text)).alias("_d"))
        first = (ids.select("prompt_id", id_col).distinct().join(digest, id_col)
                 .groupBy("prompt_id", *parts, "_d").agg(F.min(id_col).alias(id_col)))
        return first.join(rows.select(id_col, text), id_col).select("prompt_id", *parts, text)

    # ---- B18
    def context_nodes(self) -> DataFrame:
        return self._fetched(self.node_occurrences(), "node_id", self.nodes, ["name", "labeled"], "description")

    # ---- B19
    def context_relations(self) -> DataFrame:
        ids = (self.node_rows.select("prompt_id", "edge_id")
               .unionByName(self.endpoints.select("prompt_id", F.col("item_id").alias("edge_id")))
               .unionByName(shown_neighbors(self.hoods, self.endpoints).select("prompt_id", F.col("nb_edge_id").alias("edge_id"))))
        filled = self.edges.where(F.coalesce("description", F.lit("")) != "")
        return self._fetched(ids, "edge_id", filled, [], "description")

    # ---- B20
    def metadata_last_wins(self) -> DataFrame:
        told = self.nodes.where(F.col("metadata") != "").select("node_id", "name", "metadata")
        occ = self.node_occurrences().join(told, "node_id")
        order = F.struct(F.col("phase"), -F.col("score"), F.col("item_id"), F.col("role"),
                         F.col("node_id"))
        return occ.groupBy("prompt_id", "name").agg(F.max_by("metadata", order).alias("metadata"))

    # ---- B21
    def metadata_distinct(self) -> DataFrame:
        m = self.metadata_last_wins().select(
            "prompt_id", F.translate("metadata", ", ", "").alias("metadata"))
        return m.where(F.col("metadata") != "").distinct()

    # ---- B22
    def _node_lines(self) -> DataFrame:
        return (self.context_nodes()
                    .where((F.col("name") != "") & (F.col("labeled") != ""))
                    .select("prompt_id", F.concat(F.col("name"), F.lit(": is a "), F.col("labeled"),
                                                  F.lit(" of description: "), F.col("description"))
                            .alias("line")))

    def context_lines(self) -> DataFrame:
        """Long form of the rendered context: (prompt_id, section, line), one row
        per node or relation line. Nothing is grouped, so a prompt whose hits
        touch a hub stays spread over many tasks."""
        nodes = self._node_lines().withColumn("section", F.lit("nodes"))
        rels = self.context_relations().select("prompt_id", F.col("description").alias("line")) \
                   .withColumn("section", F.lit("relationships"))
        return nodes.unionByName(rels).select("prompt_id", "section", "line")

    def numbered_lines(self) -> DataFrame:
        """``context_lines`` with ``position``: a line's place in its section
        (sorted by text, equal lines in any order), numbered in many tasks. Range boundaries
        come from the lines' beginnings, so no whole line is sampled to the driver."""
        return with_row_index(self.context_lines(), ["line"], "position", group_by=["prompt_id", "section"], boundary_chars=BOUNDARY_CHARS)

    def contexts(self) -> DataFrame:
        """(prompt_id, node_block, rel_block) for prompts with at least one
        node or relation: the sorted lines of each section joined into text."""
        rel_lines = self.context_relations().select("prompt_id", F.col("description").alias("line"))
        nb = _block(self._node_lines(), "node_block")
        rb = _block(rel_lines, "rel_block")
        return nb.join(rb, "prompt_id", "full")

    # ---- B23
    def retrieve(self, prompts: DataFrame) -> DataFrame:
        """One row per prompt: context text and sorted, comma-joined metadata."""
        meta = (self.metadata_distinct().groupBy("prompt_id")
                    .agg(F.array_join(F.sort_array(F.collect_list("metadata")), ",").alias("metadata")))
        out = prompts.select("prompt_id").join(self.contexts(), "prompt_id", "left") \
                     .join(meta, "prompt_id", "left")
        return out.select("prompt_id", render_context(F.col("node_block"), F.col("rel_block")).alias("context"),
                          F.coalesce(F.col("metadata"), F.lit("")).alias("metadata"))


def _block(lines: DataFrame, name: str) -> DataFrame:
    """Sorted lines of one prompt, each followed by the rule line."""
    return lines.groupBy("prompt_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("line")),
                                 lambda x: F.concat(x, F.lit("\n" + ITEM_RULE))), "\n").alias(name))


def render_context(node_block, rel_block) -> F.Column:
    """Heading, node lines, a blank line, heading, relation lines."""
    return F.concat_ws("\n", F.lit(NODES_HEADING), node_block, F.lit("\n"),
                       F.lit(RELATIONS_HEADING), rel_block)
