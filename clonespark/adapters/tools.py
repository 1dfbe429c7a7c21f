"""Commands of external programs, and running them from a driver or within tasks."""

from __future__ import annotations

import shutil
import subprocess
import tempfile
from collections.abc import Callable, Iterator
from enum import IntEnum
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame

ChainType = IntEnum(
    "ChainType",
    "HUMAN_HEAVY HUMAN_LIGHT CHICKEN_HEAVY CHICKEN_LIGHT RABBIT_HEAVY RABBIT_KAPPA MOUSE_BALBC_HEAVY MOUSE_BALBC_LIGHT MOUSE_C57BL6_HEAVY MOUSE_C57BL6_LIGHT "
    "MOUSE_BETA MOUSE_ALPHA HUMAN_BETA HUMAN_ALPHA HUMAN_DELTA HUMAN_GAMMA",
)
HEAVY = {ChainType.HUMAN_HEAVY, ChainType.RABBIT_HEAVY, ChainType.MOUSE_C57BL6_HEAVY, ChainType.MOUSE_BALBC_HEAVY}
LIGHT = {ChainType.HUMAN_LIGHT, ChainType.RABBIT_KAPPA, ChainType.MOUSE_C57BL6_LIGHT, ChainType.MOUSE_BALBC_LIGHT}
CHICKEN = {ChainType.CHICKEN_HEAVY, ChainType.CHICKEN_LIGHT}
BETA = {ChainType.HUMAN_BETA, ChainType.MOUSE_BETA}
ALPHA = {ChainType.HUMAN_ALPHA, ChainType.MOUSE_ALPHA}


class MissingTool(RuntimeError):
    """A program isn't on the PATH."""


def run(command: list[str], **options) -> str:
    """What a command prints. A missing program or a failure is an error."""
    if shutil.which(command[0]) is None:
        raise MissingTool(f"{command[0]} is not on the PATH; give its result table instead")
    return subprocess.run(command, check=True, capture_output=True, text=True, **options).stdout


def makeblastdb(fasta: str, nucleotides: bool = True) -> list[str]:
    return ["makeblastdb", "-in", fasta, "-dbtype", "nucl" if nucleotides else "prot"]


def blast(query: str, db: str, nucleotides: bool = True, evalue: float = 1e-5, gapopen: int = 1, gapextend: int = 2, word_size: int = 10, alignments: int = 10, threads: int = 10) -> list[str]:
    """Pairwise text output of blastn or blastp."""
    words = ["-word_size", str(word_size)] if nucleotides else []
    return ["blastn" if nucleotides else "blastp", "-query", query, "-db", db, "-evalue", str(evalue), "-gapopen", str(gapopen), "-gapextend", str(gapextend), *words, "-num_alignments", str(alignments), "-num_threads", str(threads)]


def igblast(chain: ChainType, query: str, domain_system: str = "kabat", protein: bool = False, db_dir: str = "database", **options: str) -> list[str]:
    """igblastn, or igblastp for proteins; germline databases by organism in db_dir."""
    organism = chain.name.split("_")[0].lower()
    receptor = "TCR" if chain in BETA | ALPHA or chain in (ChainType.HUMAN_DELTA, ChainType.HUMAN_GAMMA) else "Ig"
    command = ["igblastp" if protein else "igblastn", "-query", query, "-organism", organism, "-ig_seqtype", receptor, "-domain_system", domain_system, "-germline_db_V", f"{db_dir}/{organism}_V"]
    if not protein:
        command += ["-germline_db_D", f"{db_dir}/{organism}_D", "-germline_db_J", f"{db_dir}/{organism}_J", "-auxiliary_data", f"optional_file/{organism}_gl.aux"]
    return command + [x for k, v in options.items() for x in (f"-{k}", str(v))]


def clustal_omega(fasta: str, out: str) -> list[str]:
    return ["clustalo", "-i", fasta, "-o", out, "--force"]


def pear(forward: str, reverse: str, out: str, threads: int = 4) -> list[str]:
    return ["pear", "-f", forward, "-r", reverse, "-o", out, "-j", str(threads)]


def through_tool(df: DataFrame, name: str, seq: str, command: Callable[[str], list[str]], parse: Callable[[str], pd.DataFrame], schema: str) -> DataFrame:
    """Runs a command on each batch of sequences, written as FASTA to the task's own temporary folder, and parses what it prints."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                with tempfile.TemporaryDirectory() as folder:
                    path = Path(folder, "query.fasta")
                    path.write_text("".join(f">{n}\n{s}\n" for n, s in zip(frame[name], frame[seq])))
                    yield parse(run(command(str(path)), cwd=folder))

    return df.select(name, seq).mapInPandas(batches, schema)
