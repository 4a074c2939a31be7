"""Vocabularies that the SQL oracles go by, stated apart from the engine"s own.

A wrong entry in either place makes a query differ from its oracle.
"""

# --- fixed values ---------------------------------------------------------------
IMPACT_RANKS = {"HIGH": 4, "MODERATE": 3, "LOW": 2, "MODIFIER": 1}

CHROMOSOMES = [*[f"chr{i}" for i in range(1, 23)], "chrX", "chrY", "chrM"]

#: Consequence terms from the most to the least severe, by impact.
LADDER = [
    ("HIGH", """
        transcript_ablation
        splice_acceptor_variant
        splice_donor_variant
        stop_gained
        frameshift_variant
        stop_lost
        start_lost
        transcript_amplification
        feature_elongation
        feature_truncation
    """),
    ("MODERATE", """
        inframe_insertion
        inframe_deletion
        missense_variant
        protein_altering_variant
    """),
    ("LOW", """
        splice_region_variant
        incomplete_terminal_codon_variant
        start_retained_variant
        stop_retained_variant
        synonymous_variant
    """),
    ("MODIFIER", """
        coding_sequence_variant
        mature_miRNA_variant
        5_prime_UTR_variant
        3_prime_UTR_variant
        non_coding_transcript_exon_variant
        intron_variant
        NMD_transcript_variant
        non_coding_transcript_variant
        upstream_gene_variant
        downstream_gene_variant
        TFBS_ablation
        TFBS_amplification
        TF_binding_site_variant
    """),
    ("MODERATE", """
        regulatory_region_ablation
    """),
    ("MODIFIER", """
        regulatory_region_amplification
        regulatory_region_variant
        intergenic_variant
    """),
]
SEVERITY_LADDER = [(term, impact) for impact, terms in LADDER for term in terms.split()]
