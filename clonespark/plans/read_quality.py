"""Quality reports of paired reads: python -m clonespark.plans.read_quality -d FOLDER -j THREADS."""

from __future__ import annotations

import argparse
import os
from html import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clonespark.adapters import tools
from clonespark.operators.diversity import phred, read_totals, score_histogram
from clonespark.sources.delimited import write_table
from clonespark.sources.sequences import paired_files, read_fastq


def report(spark: SparkSession, path: str, forward: int = 0, reverse: int = 0) -> tuple[DataFrame, DataFrame]:
    """Totals and histogram of a FASTQ file's scores, without the primers at both ends."""
    reads = read_fastq(spark, path).select(phred("quality").alias("scores"))
    return read_totals(reads, "scores"), score_histogram(reads, "scores", forward, reverse)


def chart(histogram: list[dict], n_reads: int, title: str) -> str:
    """Cumulative shares of least and median scores as bars, from 40 down to 0: an SVG drawing."""
    bars = []
    for i, r in enumerate(sorted(histogram, key=lambda r: -r["qscore"])):
        for k, (name, colour) in enumerate((("least_cum", "#00b7c2"), ("median_cum", "#d9c400"))):
            height = 300 * r[name] / max(n_reads, 1)
            bars.append(f'<rect x="{50 + 14 * i + 6 * k}" y="{340 - height:.2f}" width="6" height="{height:.2f}" fill="{colour}"/>')
        if i % 5 == 0:
            bars.append(f'<text x="{50 + 14 * i}" y="358" font-size="11">{r["qscore"]}</text>')
    named = f'<text x="50" y="20">{escape(title)}: {n_reads} reads</text><text x="50" y="376" font-size="11">least (blue) and median (yellow) score, cumulative share</text>'
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="660" height="390">{named}<path d="M45 40V340H640" fill="none" stroke="black"/>{"".join(bars)}</svg>'


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("-d", "--directory", required=True)
    parser.add_argument("-j", "--threads", type=int, default=4)
    parser.add_argument("--forward", type=int, default=0, help="scores of the forward primer")
    parser.add_argument("--reverse", type=int, default=0, help="scores of the reverse primer")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("read quality").getOrCreate()
    for pair in paired_files(spark, given.directory).collect():
        out = os.path.join(given.directory, "merged", pair["sample"])
        merged = f"{out}.assembled.fastq"
        if not os.path.exists(merged) or not os.path.getsize(merged):
            os.makedirs(os.path.dirname(out), exist_ok=True)
            local = [p.removeprefix("file:") for p in (pair["r1"], pair["r2"])]
            tools.run(tools.pear(*local, out, given.threads))
        totals, histogram = report(spark, merged, given.forward, given.reverse)
        write_table(totals, f"{out}.totals", mode="ignore")
        write_table(histogram.orderBy(F.desc("qscore")), f"{out}.scores", mode="ignore")
        drawing = chart([r.asDict() for r in histogram.collect()], totals.first()["n_reads"], pair["sample"])
        spark.createDataFrame([(drawing,)], "value string").coalesce(1).write.mode("ignore").text(f"{out}.svg")


if __name__ == "__main__":
    main()
