"""Lookup tables, markers and codes that results depend on."""

# IRI prefix -> source abbreviation, in order; the last match wins.
PREFIX_SOURCES = [
    ("http://api.brain-map.org/api/v2/data/TransgenicLine/", "AIBS.TL"),
    ("http://uri.interlex.org/aibs/uris/mouse/labels/", "AIBS.MUS.LAB"),
    ("http://uri.interlex.org/aibs/uris/mouse/versions/", "AIBS.MUS.VER"),
    ("http://api.brain-map.org/api/v2/data/Specimen/", "AIBS.SPEC"),
    ("http://api.brain-map.org/api/v2/data/TransgenicLine/", "ALLENTRANSGENICLINE"),
    ("http://uri.interlex.org/tgbugs/uris/readable/atlas/", "ATOM"),
    ("http://purl.org/dc/elements/1.1/", "DC"),
    ("http://purl.org/dc/terms/", "DC.TERMS"),
    ("http://xmlns.com/foaf/0.1/", "FOAF"),
    ("http://www.ncbi.nlm.nih.gov/gene", "ENTREZ"),
    ("http://purl.jp/bio/12/glyco/conjugate#", "GCO"),
    ("http://purl.jp/bio/12/glyco/glycan#", "GLYCAN"),
    ("http://purl.jp/bio/12/glyco/glycoconjugate#", "GLYCOCONJUGATE"),
    ("http://purl.humanatlas.io/valueset/", "HRAVS"),
    ("http://uri.interlex.org/base/readable/type/", "ILX.TYPE"),
    ("http://uri.interlex.org/base/readable/", "ILX.R"),
    ("http://uri.interlex.org/tgbugs/uris/readable/", "ILX.TR"),
    ("http://jaxmice.jax.org/strain/", "JAX"),
    ("http://api.brain-map.org/api/v2/data/Structure/", "MBA"),
    ("http://uri.interlex.org/MIRO/uris/readable/", "MIRO"),
    ("http://www.mmrrc.org/catalog/getSDS.jsp?mmrrc_id=", "MMRRC"),
    ("http://uri.interlex.org/tgbugs/uris/readable/sparc-nlp/mmset1/", "MMSET1"),
    ("http://uri.interlex.org/tgbugs/uris/readable/sparc-nlp/mmset2cn/", "MMSET2CN"),
    ("http://uri.interlex.org/tgbugs/uris/readable/sparc-nlp/mmset4/", "MMSET4"),
    ("http://uri.neuinfo.org/nif/nifstd/readable/", "NIFSTD.NIFRID"),
    ("http://uri.neuinfo.org/nif/nifstd/birnlex_", "NIFSTD.BIRNLEX"),
    ("http://uri.neuinfo.org/nif/nifstd", "NIFSTD"),
    ("http://uri.neuinfo.org/nif/nifstd/nifext_", "NIFSTD.NIFEXT"),
    ("http://uri.neuinfo.org/nif/nifstd/nlx_", "NIFSTD.NLX"),
    ("http://uri.neuinfo.org/nif/nifstd/nlx_neuron_nt_", "NIFSTD.NLX.NEURNT"),
    ("http://uri.neuinfo.org/nif/nifstd/oen_", "NIFSTD.OEN"),
    ("http://neurolex.org/wiki/", "NLX.WIKI"),
    ("http://uri.interlex.org/npo/uris/neurons/", "NPOKB"),
    ("http://uri.interlex.org/paxinos/uris/rat/labels/", "PAX.PAXRAT"),
    ("http://uri.interlex.org/paxinos/uris/spine/labels/", "PAX.PAXSPN"),
    ("http://www.pantherdb.org/panther/", "PTHR"),
    ("http://uri.interlex.org/temp/uris/phenotype-indicators/", "TEMPIND"),
    ("http://uri.neuinfo.org/nif/nifstd/nlx_mol_", "NIFSTD.NLX.MOL"),
    ("http://uri.neuinfo.org/nif/nifstd/nlx_cell_", "NIFSDT.NLX.CELL"),
    ("http://uri.neuinfo.org/nif/nifstd/nlx_anat_", "NIFSTD.NLX.ANAT"),
    ("http://uri.neuinfo.org/nif/nifstd/nlx_organ_", "NIFSTD.NLX.ORG"),
    ("https://repo.metadatacenter.org/templates/", "CEDAR"),
    ("https://repo.metadatacenter.org/template-fields/", "CEDAR"),
    ("http://www.w3.org/2001/XMLSchema#", "XSD"),
]

# Sources whose codes are read with PREFIX_SOURCES.
HASH_PREFIX_SOURCES = ["GLYCOCOO", "GLYCORDF"]
UNDERSCORE_PREFIX_SOURCES = ["NPO", "NPOSKCAN"]

# Relation code -> relation label, in order; the first match wins.
RELATION_LABELS = [
    ("ido_0000664", "has_material_basis_in"),
    ("cl_4030044", "has_not_completed"),
    ("efo_0000784", "has_disease_location"),
    ("efo_0001697", "has_unit_of"),
    ("efo_0006351", "has_about_it"),
    ("hancestro_0301", "has_ancestry_status"),
    ("obi_0000293", "has_specified_input"),
    ("obi_0000295", "is_specified_input_of"),
    ("obi_0000299", "has_specified_output"),
    ("mondo_0100332", "disease_has_primary_infectious_agent"),
    ("mondo_0100333", "disease_caused_by_reactivation_of_latent_infectious_agent"),
    ("gorel_0002004", "results_in_fission_of"),
    ("ilx_0112785", "is_part_of"),
    ("obi_0000312", "is_specified_output_of"),
    ("obi_0000417", "achieves_planned_objective"),
    ("obi_1110060", "process_is_result_of"),
    ("obi_0000643", "relation_label"),
    ("obi_0003385", "has_assay_target_context"),
    ("efo_0000784", "GM12878"),
    ("hancestro_0330", "has_ancestry_status"),
    ("sio_000628", "refers_to"),
    ("obi_0000107", "provides_service_consumer_with"),
    ("obi_0000304", "is_manufactured_by"),
    ("obi_0000646", "provisions"),
    ("obi_0000833", "objective_achieved_by"),
    ("obi_0000846", "is_member_of_organization"),
    ("obi_0001637", "has_disposition_to_bind"),
    ("obi_0001688", "has_organization_member"),
    ("obi_0001927", "specifies_value_of"),
    ("obi_0001938", "has_value_specification"),
    ("obi_0003703", "has_study_design"),
    ("obi_1110119", "bound_to"),
    ("bfo_0000156", "has_temporal_occupant"),
    ("bfo_0000184", "history_of"),
    ("geo_000000329", "is_subordinate_authority_of"),
    ("obib_0000733", "administrates"),
    ("obib_0000734", "is contact information for"),
    ("omrse_00000020", "is_aggregate_of"),
    ("obib_0000732", "owns"),
    ("orphanet_317343", "germline mutation in"),
    ("orphanet_317344", "disease_causing_somatic_mutations_in"),
    ("orphanet_317345", "major_susceptibility_factor_in"),
    ("orphanet_317346", "modifying_germline_mutation_in"),
    ("orphanet_317348", "part_of_a_fusion_gene-in"),
    ("orphanet_317349", "role_in_the_phenotype_of"),
    ("orphanet_327767", "candidate_gene_teste_ in"),
    ("orphanet_410295", "disease_causing_germline_mutations_loss_of_function_in"),
    ("orphanet_410296", "disease_causing_germline_mutations_gain_of_function_in"),
    ("orphanet_c057", "referred_to"),
    ("orphanet_465410", "biomarker_tested_in"),
    ("orphanet_c040", "has_chromosomal_location"),
    ("orphanet_c056", "Familial_pseudohyperkalemia_type_1"),
]

# Codes of the reaction types in the pathway value set.
REACTION_TYPE_CODES = [
    "REACTOME_VS:C0006",
    "REACTOME_VS:C0007",
    "REACTOME_VS:C0008",
    "REACTOME_VS:C0009",
    "REACTOME_VS:C0010",
    "REACTOME_VS:C0011",
]

# Entities of a template that the template map does not name.
DEFAULT_TEMPLATE_ENTITIES = ["HUBMAP:C040001", "SENNET:C050002"]
TEMPLATE_PARENT = "https://schema.metadatacenter.org/core/Template"

# Cross-references of two field types that differ from their names.
FIELD_TYPE_XREFS = [("number", "XSD:float"), ("datetime", "XSD:dateTime")]

# Columns and keys of an annotation file.
GTF_COLUMNS = [
    "chromosome_name", "annotation_source", "feature_type", "genomic_start_location",
    "genomic_end_location", "score", "genomic_strand", "genomic_phase", "column_9",
]
GTF_KEYS = [
    "gene_id", "transcript_id", "gene_type", "gene_status", "gene_name", "transcript_type",
    "transcript_status", "transcript_name", "exon_number", "exon_id", "level", "tag", "ccdsid",
    "havana_gene", "havana_transcript", "protein_id", "ont", "transcript_support_level",
    "remap_status", "remap_original_id", "remap_original_location", "remap_num_mappings",
    "remap_target_status", "remap_substituted_missing_target", "hgnc_id", "mgi_id",
]

# Names used in triple tables.
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDFS_TYPE = "http://www.w3.org/2000/01/rdf-schema#type"
RDFS_LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
RDFS_SUBCLASS = "http://www.w3.org/2000/01/rdf-schema#subClassOf"
OWL_CLASS = "http://www.w3.org/2002/07/owl#Class"
OWL_AXIOM = "http://www.w3.org/2002/07/owl#Axiom"
OWL_DISJOINT = "http://www.w3.org/2002/07/owl#disjointWith"
OWL_SOURCE = "http://www.w3.org/2002/07/owl#annotatedSource"
OWL_TARGET = "http://www.w3.org/2002/07/owl#annotatedTarget"
OWL_PROPERTY = "http://www.w3.org/2002/07/owl#annotatedProperty"
OWL_EQUIVALENT = "http://www.w3.org/2002/07/owl#equivalentClass"
OWL_INTERSECTION = "http://www.w3.org/2002/07/owl#intersectionOf"
OWL_UNION = "http://www.w3.org/2002/07/owl#unionOf"
OWL_ON_PROPERTY = "http://www.w3.org/2002/07/owl#onProperty"
OWL_FILLERS = [
    "http://www.w3.org/2002/07/owl#someValuesFrom", "http://www.w3.org/2002/07/owl#allValuesFrom",
    "http://www.w3.org/2002/07/owl#hasValue", "http://www.w3.org/2002/07/owl#onClass",
]
RDF_FIRST = "http://www.w3.org/1999/02/22-rdf-syntax-ns#first"
RDF_REST = "http://www.w3.org/1999/02/22-rdf-syntax-ns#rest"
RDF_NIL = "http://www.w3.org/1999/02/22-rdf-syntax-ns#nil"
OBO_SYNONYM = "http://www.geneontology.org/formats/oboInOwl#hasExactSynonym"
OBO_DBXREF = "http://www.geneontology.org/formats/oboInOwl#hasDbXref"
OBO_DEFINITION = "http://purl.obolibrary.org/obo/IAO_0000115"
OBO_PREFIX = "http://purl.obolibrary.org/obo/"
