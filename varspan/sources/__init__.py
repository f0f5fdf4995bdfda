"""Readers and writers of VCF, FASTA, FASTQ and small text tables."""
