"""Fixed values shared by every table. They must stay as they are for results to agree."""

# The target of a withdrawn id, and the ways sources spell "missing".
WITHDRAWN = "Entry Withdrawn"
MISSING = ("-", "", "NA")

# Mapping classes (fan-in of the target : fan-out of the old id).
ONE_TO_ONE = "1:1"
MANY_TO_ONE = "n:1"
ONE_TO_MANY = "1:n"
MANY_TO_MANY = "n:n"
ONE_TO_NONE = "1:0"

# Predicate of each class.
CONSIDER = "oboInOwl:consider"
REPLACED_BY = "IAO:0100001"
CONSIDER_CLASSES = (ONE_TO_NONE, ONE_TO_MANY, MANY_TO_MANY)
REPLACED_CLASSES = (ONE_TO_ONE, MANY_TO_ONE)

# Comment of each class.
CLASS_COMMENTS = {
    ONE_TO_MANY: "ID (subject) is split into multiple.",
    ONE_TO_ONE: "ID (subject) is replaced.",
    MANY_TO_MANY: "This ID (subject) and other ID(s) are merged/split into multiple ID(s).",
    MANY_TO_ONE: "This ID (subject) and other ID(s) are merged into one ID.",
    ONE_TO_NONE: "ID (subject) withdrawn/deprecated.",
}
DATE_PREFIX = "Withdrawn date: "
TARGET_RETIRED_NOTE = " Object is also withdrawn."
RELEASE_PREFIX = " Release: "

# Comments of label rows.
NOMENCLATURE_COMMENT = "The secondary symbol is the nomenclature symbol"
UNOFFICIAL_COMMENT = "Unofficial symbol for the gene"
ALIAS_COMMENT = (
    "Alias symbol: Alternative symbols that have been used to refer to the gene. Aliases may be"
    " from literature, from other databases or may be added to represent membership of a gene group."
)
PREVIOUS_COMMENT = (
    "Previous symbol: Any symbols that were previously HGNC-approved nomenclature."
)

# Taxa (human; human and mouse).
HUMAN = "9606"
HUMAN_AND_MOUSE = ("9606", "10090")

# Where each source publishes its data.
NCBI_HISTORY_URL = "https://ftp.ncbi.nih.gov/gene/DATA/gene_history.gz"
NCBI_INFO_URL = "https://ftp.ncbi.nih.gov/gene/DATA/gene_info.gz"
HGNC_URL = "https://www.genenames.org/download/archive/quarterly/tsv/"
UNIPROT_SECONDARY_URL = (
    "https://ftp.ebi.ac.uk/pub/databases/uniprot/current_release/knowledgebase/complete/docs/sec_ac.txt"
)
UNIPROT_DELETED_URL = (
    "https://ftp.ebi.ac.uk/pub/databases/uniprot/current_release/knowledgebase/complete/docs/delac_sp.txt"
)

# CURIE prefixes of the published mapping sets.
COMMON_PREFIXES = {
    "IAO:": "http://purl.obolibrary.org/obo/IAO_",
    "oboInOwl:": "http://www.geneontology.org/formats/oboInOwl#",
}
SOURCE_PREFIXES = {
    "ChEBI": {"ChEBI:": "http://purl.obolibrary.org/obo/CHEBI_"},
    "HMDB": {"HMDB:": "http://www.hmdb.ca/metabolites/"},
    "HGNC": {"HGNC:": "http://identifiers.org/hgnc/"},
    "NCBI": {"NCBI:": "http://www.ncbi.nlm.nih.gov/gene/"},
    "UniProt": {"UniProt:": "http://identifiers.org/uniprot/"},
    "Wikidata": {"Wikidata:": "https://bioregistry.io/wikidata:"},
}
SSSOM_LICENSE = "https://creativecommons.org/publicdomain/zero/1.0/"
SYNONYM_NOTE = "object_label represents a synonym name by which the subject_label is also known."
ALT_NAME_NOTE = "object_label represents an alternative name by which the subject_label is also known."
ALT_SYMBOL_NOTE = "object_label represents an alternative symbol by which the subject_label is also known."

# System codes of the cross-reference graph (ids, labels) and its attribute name.
SYSTEM_CODES = {"NCBI": ("L", "O"), "ChEBI": ("Ce", "O"), "HMDB": ("Ch", "O")}
SYNONYM_ATTRIBUTE = "Synonym"

# Graph vocabulary.
INSTANCE_OF = "wdt:P31"
STATEMENT_PATHS = (("p:P31", "ps:P31"), ("p:P279", "ps:P279"))
IN_TAXON = "wdt:P703"
SAME_AS = "owl:sameAs"
LABEL = "rdfs:label"
ALT_LABEL = "skos:altLabel"
ENTITY_IRI = "http://www.wikidata.org/entity/"
CHEMICAL_CLASSES = ("Q11173", "Q36496", "Q79529", "Q55662747", "Q113145171")
GENE_CLASSES = ("Q7187",)
PROTEIN_CLASSES = ("Q8054",)
HUMAN_TAXON = "Q15978631"
FAILED_EXTRACT = "TimeoutException"
