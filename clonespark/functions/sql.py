"""The functions that are single expressions, for SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from clonespark.functions.dna import COMPLEMENT, IUPAC

DEFINITIONS = {
    "reverse_complement(s STRING)": f"RETURN reverse(translate(s, '{IUPAC}', '{COMPLEMENT}'))",
    "gene_family(gene STRING)": "RETURN substring_index(gene, '*', 1)",
    "isotype_of(gene STRING)": "RETURN substring(substring_index(gene, '*', 1), 4)",
    "trim_to_frame(s STRING, fr1_to INT)": "RETURN substring(s, fr1_to % 3 + 1)",
    "motif_count(protein STRING, pattern STRING)": "RETURN coalesce(regexp_count(protein, pattern), 0)",
}


def register(spark: SparkSession) -> list[str]:
    """Makes temporary SQL functions of them; their names."""
    for head, body in DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} {body}")
    return [head.split("(")[0] for head in DEFINITIONS]
