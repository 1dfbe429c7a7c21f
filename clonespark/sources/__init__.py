"""Readers and writers of delimited, FASTA and FASTQ files."""
