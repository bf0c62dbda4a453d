"""Dictionaries of the relation miner. All are defaults: functions take them as parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# Names that are not genes (case-sensitive).
BLACKLIST = (
    "PCR", "qPCR", "RT-PCR", "RT-qPCR", "qRT-PCR", "RNA-seq", "scRNA-seq", "ChIP", "ChIP-seq", "CLIP", "CLIP-seq", "RIP", "RIP-seq", "RNAi", "CRISPR",
    "Cas9", "TALEN", "ZFN", "GFP", "GUS", "LUC", "RFP", "YFP", "CFP", "mCherry", "GST", "MBP", "His", "FLAG", "HA", "Myc", "T7", "35S", "CaMV35S", "Ubi",
    "Actin", "NOS", "WT", "OE", "amiRNA", "MIM", "STTM", "Ctrl", "Control", "cDNA", "mRNA", "tRNA", "rRNA", "siRNA", "sRNA", "snRNA", "snoRNA", "ncRNA",
    "lncRNA", "circRNA", "pri-miRNA", "pre-miRNA", "dsRNA", "ssRNA", "ssDNA", "dsDNA", "ABA", "GA", "GA3", "IAA", "JA", "SA", "BR", "ET", "ETH", "MeJA",
    "ACC", "SL", "GR24", "ROS", "H2O2", "NO", "NO3", "NH4", "Pi", "ATP", "GTP", "ADP", "GDP", "NADPH", "NADH", "Ca2", "Ca2+", "K+", "Na+", "Cl-", "SD",
    "SEM", "ANOVA", "LSD", "FDR", "NCBI", "BLAST", "GO", "KEGG", "COG", "Pfam", "RAP", "MSU", "TAIR", "Ensembl", "SRA", "GEO", "DEG", "DEGs", "FPKM", "RPKM",
    "TPM", "CPM", "Chr1", "Chr2", "Chr3", "Chr4", "Chr5", "Chr6", "Chr7", "Chr8", "Chr9", "Chr10", "Chr11", "Chr12", "DNA", "RNA", "ORF", "UTR", "CDS",
    "SNP", "QTL", "SSR", "CTAB", "EDTA", "SDS", "PAGE", "TEMED", "APS", "LIKE", "NS3", "NS4", "NS2", "NS1", "IR64", "IR36", "IR8", "IR72", "IR24", "IR29",
    "ZH11", "ZH17", "PB1", "TN1", "RP2068", "N22", "PKL", "AG1", "LDLRAP1", "AC4", "BMY", "CELL", "CR1", "CR2", "Cu2", "DEAD", "DOB1", "DP", "GT", "Guy11",
    "HT14", "HT54", "Hap1", "Hap2", "Hap3", "IMR90", "LYP9", "NB", "NF", "OMTN", "OXMFAP1", "Osaba1", "Osmtd1", "PR", "Pho81", "RSV", "RT", "SK12", "SO4",
    "SYG1", "WEB", "XPR1", "Ziyu44", "AUXIN", "BPH", "DOMAIN2", "DR", "EF", "FACTOR1", "III", "IR56", "IRBB5", "PSI", "PTI", "PXO86", "PXO99", "RBSDV",
    "TRANS", "UCL", "WRKY", "IIB",
)

# Known plant genes and gene families.
WHITELIST = (
    "AGO1", "AGO2", "AGO4", "AGO5", "AGO6", "AGO7", "AGO10", "AGO17", "AGO18", "DCL1", "DCL2", "DCL3", "DCL4", "RDR1", "RDR2", "RDR6", "SPL2", "SPL3",
    "SPL4", "SPL5", "SPL6", "SPL7", "SPL8", "SPL9", "SPL10", "SPL11", "SPL12", "SPL13", "SPL14", "SPL15", "SPL16", "SPL17", "SPL18", "AP2", "GRF1", "GRF2",
    "GRF3", "GRF4", "GRF5", "GRF6", "GRF7", "GRF8", "GRF9", "GRF10", "NAC1", "NAC2", "NAC3", "NAC4", "NAC5", "NAC6", "NAC", "MYB2", "MYB3", "MYB4", "MYB5",
    "MYB6", "MYB", "WRKY45", "WRKY55", "WRKY71", "WRKY", "TCP21", "TCP", "PHO2", "CSD1", "CSD2", "CSD3", "CSD4", "TAS3", "IPA1", "HD3", "HD5", "HYL1", "SE",
    "DCL", "AGO", "RDR", "SPL", "ARF", "FTL", "MFS1", "MFS2", "RFT1", "TB1", "SLR1", "MPK3", "MPK6", "SNB", "IDS1", "GAMYB", "GmPT5", "OsAFB2", "OsARF10",
    "OsGAMYBL2", "OsGRF4", "OsPHO2", "OsRPC53", "OsSOD2", "OsTCP21", "OsTIR1", "AGL16", "ARF8", "CIPK10", "EIN2", "LOC_Os08g16914", "LOC_Os08g42700.1",
    "Os06g0708700", "OsARF18", "OsCUC1", "OsCaML2", "OsDCL1", "OsDRM2", "OsGH3", "OsGRF8", "OsHAM1", "OsHAM2", "OsHAM3", "OsHAM4", "OsMADS57", "OsMYB2",
    "OsSPL14", "OsSPL17", "OsSPL2", "OsSPL7", "OsUCL17", "TIR1",
)

# Words near a candidate that speak for a gene (as substrings of lower-case text).
CONTEXT_SIGNALS = (
    "gene", "genes", "encodes", "encode", "encoded", "encoding", "target", "targets", "targeted", "targeting",
    "regulate", "regulates", "regulated", "regulating", "regulation", "express", "expresses", "expressed", "expressing", "expression",
    "overexpress", "overexpresses", "overexpressed", "overexpression", "knockout", "knock out", "knock-out", "knockdown", "knock down",
    "mutant", "mutants", "mutation", "mutations", "mutated", "transcribe", "transcribes", "transcribed", "transcription",
    "transgenic", "transgene", "locus", "loci", "allele", "alleles", "transcription factor", "repressor", "activator", "suppressor",
    "family", "member", "homolog", "homologue", "ortholog", "cleave", "cleaves", "cleaved", "cleavage", "protein", "proteins",
)

# Stems before, and words behind, a family name that speak strongly for a gene.
STRONG_STEMS = ("gene", "genes", "encod", "target", "regulat", "express", "transcri", "protein")
STRONG_TAIL = r"transcription\s*factors?|genes?|family|families|proteins?|domain\s*proteins?|box\s*proteins?|factors?|repressors?|activators?|regulators?"

# Relation words, each counted once, by the relation class that they stand for; classes in order of precedence.
RELATION_CLASSES = {
    "cleavage": ("cleave", "cleaves", "cleaved", "cleavage"),
    "repression": ("repress", "represses", "repressed", "repression", "silence", "silences", "silenced", "silencing", "suppress", "suppresses", "suppression"),
    "targeting": ("target", "targets", "targeted", "targeting"),
    "regulation": (
        "regulate", "regulates", "regulated", "regulation", "mediate", "mediates", "mediated", "contribute", "contributes", "contributed",
        "modulate", "modulates", "modulated", "control", "controls", "controlled", "activate", "activates", "activated",
        "involve", "involves", "involved", "require", "requires", "required",
    ),
    "binding": ("bind", "binds", "binding", "bound", "recogni", "recognizes", "recognition"),
    "interaction": ("interact", "interacts", "interaction"),
}
# One more word counts as a signal although it gives no class.
RELATION_SIGNALS = (*(w for ws in RELATION_CLASSES.values() for w in ws), "regulating")

# miRNA prefix, gene prefix and common name of each species, in order.
SPECIES = (
    ("osa", "Os", "rice"), ("tae", "Ta", "wheat"), ("zma", "Zm", "maize"), ("hvu", "Hvu", "barley"), ("sbi", "Sbi", "sorghum"),
    ("ath", "At", "Arabidopsis"), ("aly", "Al", "Arabidopsis lyrata"), ("gma", "Gm", "soybean"), ("pvu", "Pv", "common bean"),
    ("mtr", "Mt", "alfalfa"), ("cas", "Cas", "chickpea"), ("lja", "Lj", "lotus"), ("sly", "Sly", "tomato"), ("stu", "Stu", "potato"),
    ("nta", "Nta", "tobacco"), ("can", "Ca", "pepper"), ("ppe", "Ppe", "peach"), ("mdm", "Mdm", "apple"), ("vvi", "Vvi", "grape"),
    ("csi", "Csi", "orange"), ("cme", "Cm", "melon"), ("far", "Fv", "strawberry"), ("mac", "Ma", "banana"), ("cpa", "Cp", "papaya"),
    ("ghr", "Gh", "cotton"), ("bna", "Bna", "rapeseed"), ("bra", "Bra", "turnip"), ("ptc", "Ptc", "poplar"), ("pta", "Pt", "pine"),
    ("mes", "Mes", "cassava"),
)
# One gene prefix more than the species have.
LEGACY_PREFIXES = {gene: mir for mir, gene, _ in SPECIES} | {"Ath": "ath"}

# Keywords of species in lower-case text, in order of precedence.
SPECIES_KEYWORDS = (
    ("rice", "osa"), ("oryza", "osa"), ("wheat", "tae"), ("triticum", "tae"), ("maize", "zma"), ("corn", "zma"), ("zea", "zma"),
    ("barley", "hvu"), ("hordeum", "hvu"), ("sorghum", "sbi"), ("arabidopsis", "ath"), ("thaliana", "ath"), ("soybean", "gma"),
    ("glycine", "gma"), ("common bean", "pvu"), ("phaseolus", "pvu"), ("alfalfa", "mtr"), ("medicago", "mtr"), ("chickpea", "cas"),
    ("cicer", "cas"), ("lotus", "lja"), ("tomato", "sly"), ("solanum lycopersicum", "sly"), ("potato", "stu"), ("solanum tuberosum", "stu"),
    ("tobacco", "nta"), ("nicotiana", "nta"), ("pepper", "can"), ("capsicum", "can"), ("peach", "ppe"), ("prunus persica", "ppe"),
    ("apple", "mdm"), ("malus", "mdm"), ("grape", "vvi"), ("vitis", "vvi"), ("orange", "csi"), ("citrus", "csi"), ("melon", "cme"),
    ("cucumis", "cme"), ("cucumber", "cme"), ("strawberry", "far"), ("fragaria", "far"), ("banana", "mac"), ("musa", "mac"),
    ("papaya", "cpa"), ("carica", "cpa"), ("cotton", "ghr"), ("gossypium", "ghr"), ("rapeseed", "bna"), ("brassica napus", "bna"),
    ("canola", "bna"), ("turnip", "bra"), ("brassica rapa", "bra"), ("poplar", "ptc"), ("populus", "ptc"), ("pine", "pta"),
    ("pinus", "pta"), ("cassava", "mes"), ("manihot", "mes"),
)

# Abbreviations that end no sentence.
ABBREVIATIONS = (
    "al", "fig", "figs", "eq", "eqs", "eqn", "ref", "refs", "vol", "vols", "vs", "etc", "et", "spp", "sp", "var", "vars", "eds", "approx", "dept", "dr",
    "mr", "mrs", "ms", "prof", "inc", "ltd", "co", "corp", "no", "nos", "jan", "feb", "mar", "apr", "jun", "jul", "aug", "sep", "oct", "nov", "dec", "cv",
    "cvs", "cf", "viz",
)

# Scientific names for gene lookups.
ORGANISMS = {
    "rice": "Oryza sativa", "wheat": "Triticum aestivum", "maize": "Zea mays", "Arabidopsis": "Arabidopsis thaliana",
    "soybean": "Glycine max", "barley": "Hordeum vulgare", "sorghum": "Sorghum bicolor", "tomato": "Solanum lycopersicum",
    "potato": "Solanum tuberosum", "tobacco": "Nicotiana tabacum", "poplar": "Populus trichocarpa", "grape": "Vitis vinifera",
    "peach": "Prunus persica", "apple": "Malus domestica", "rapeseed": "Brassica napus", "turnip": "Brassica rapa",
    "cotton": "Gossypium hirsutum", "orange": "Citrus sinensis", "cassava": "Manihot esculenta", "common bean": "Phaseolus vulgaris",
    "alfalfa": "Medicago truncatula", "chickpea": "Cicer arietinum", "lotus": "Lotus japonicus", "pepper": "Capsicum annuum",
    "melon": "Cucumis melo", "strawberry": "Fragaria vesca", "banana": "Musa acuminata", "papaya": "Carica papaya",
    "pine": "Pinus taeda", "Arabidopsis lyrata": "Arabidopsis lyrata",
}
# The prefix that a gene name may lose in a second lookup is the species' gene prefix.
STRIP_PREFIXES = {name: gene for _, gene, name in SPECIES}

#: Notes and labels of a reviewed table.
DEFAULT_NOTE = "Pure co-occurrence / enumeration, no biological relevance"
REGEX_NOTE = "Regex high confidence, not sent for LLM review"
UNREVIEWED_NOTE = "Not reviewed by LLM (confidence value not recognized)"


@dataclass(frozen=True)
class Dictionaries:
    """The lists that feedback extends, as literals."""

    blacklist: tuple[str, ...] = field(default=BLACKLIST)
    whitelist: tuple[str, ...] = field(default=WHITELIST)


@dataclass(frozen=True)
class ListTables:
    """The same lists as a table (list, name) of any length, which mentions are joined with."""

    names: DataFrame


Lists = Dictionaries | ListTables
