"""From reads to a functional repertoire, its similarity network, and components shared between samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonespark.adapters.align import align_clusters
from clonespark.adapters.seeded import align_to_genes
from clonespark.functions.dna import isotype_of, variable_region
from clonespark.operators import collapse, filters, graph, merging, similarity, umi
from clonespark.scratch import Scratch


def consensus_from_reads(reads: DataFrame, forward: list[str] | None = None, reverse: list[str] | None = None, distance: int = 5, vote: float = 0.6, seq: str = "sequence", count: str = "readcount") -> DataFrame:
    """full_NT and readcount: one consensus for each sub-cluster of each merged UMI."""
    scratch = Scratch(reads.sparkSession)
    found = umi.extract_umis(reads, forward, reverse, seq, count).groupBy("umi", "full_NT").agg(F.sum(count).alias("readcount"))
    order = F.xxhash64("umi", "full_NT")
    tagged = scratch.save(found.withColumn("row", F.struct(order.alias("h"), "umi", "full_NT")))
    merged = umi.merge_umis(tagged, "row")
    clusters = scratch.save(umi.sub_clusters(merged, "row").filter(filters.consensus_clusters()))
    aligned = align_clusters(clusters, ["merged_umi", "cluster"], band=distance)
    return umi.consensus_counts(umi.consensus(aligned, ["merged_umi", "cluster"], threshold=vote))


def with_isotypes(sequences: DataFrame, genes: DataFrame, seq: str = "full_NT", count: str = "readcount") -> DataFrame:
    """Sequences cut before their constant gene, collapsed by isotype. genes: index, name, full_NT."""
    hits = align_to_genes(sequences, genes, seq).filter(filters.c_gene_hit())
    top = F.get("aln.alignments", F.lit(0))
    named = hits.withColumn("_i", top["sbjct_index"]).join(genes.select(F.col("index").alias("_i"), "name"), "_i")
    cut = named.select(variable_region(seq, top["query_start"] - 1, top["sbjct_start"] - 1).alias(seq), isotype_of("name").alias("isotype"), count)
    return collapse.collapse_isotypes(cut, seq, "isotype", count)


def functional_repertoire(annotated: DataFrame, order_col: str, isotypes: list[str] | None = None) -> DataFrame:
    """Annotated sequences trimmed, merged and filtered."""
    return collapse.trim_and_merge(annotated, order_col).filter(filters.functional(isotypes))


def similarity_network(repertoire: DataFrame, order_col: str, seq: str = "CDR3_NT", threshold: int = 8, relative: float = 0.2) -> dict[str, DataFrame]:
    """vertices (with ids and components), edges, nearest distances and filtered edges of a repertoire."""
    scratch = Scratch(repertoire.sparkSession)
    vertices = scratch.save(collapse.set_ids(repertoire, seq, order_col))
    edges = scratch.save(similarity.similarity_join(vertices, "seq_id", seq, threshold, cross_length="last", order_col=order_col))
    kept = scratch.save(similarity.filter_edges(edges, vertices, "seq_id", relative, cdr3=seq))
    return {"vertices": graph.connected_vertices(vertices, kept, "seq_id"), "edges": edges, "nearest": similarity.nearest(vertices, edges, "seq_id", seq), "filtered": kept}


def shared_between(samples: dict[str, DataFrame], order_col: str, threshold: float, linkage: str = "min") -> DataFrame:
    """Components of samples merged across them, those that several samples have."""
    tagged = collapse.network_pivot(collapse.union_samples(samples), order_col)
    merged = merging.merge_components(tagged, order_col, threshold, collapse.ISOTYPES9, linkage=linkage)
    return collapse.shared_components(merged, "component_ID_merged")
