"""Fixed values of nucleotide and amino-acid sequences."""

# The IUPAC complement pairs and the standard genetic code (codons in TCAG order).
IUPAC = "ACGTRYSWKMBDHVN"
PAIRED = "TGCAYRSWMKVHDBN"
BASES = "TCAG"
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
