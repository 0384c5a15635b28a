"""Values that results depend on: names, codes, suffixes, templates, messages.

Everything here is plain data. No behaviour lives in this module.
"""

# --- fixed values: experiment status codes -------------------------------------------------
START_DOWNLOAD = 0
DOWNLOADING = 1
START_PROCESS = 10
PROCESSING = 11
SUCCESS_PROCESS = 12
RESTART_DOWNLOAD = 1000
FAIL_DOWNLOAD = 2000
FAIL_PROCESS = 2010

# --- fixed values: status texts ------------------------------------------------------------
TEXT_RETRY = "Download Failed. Retry!"
TEXT_DOWNLOADED = "downloaded"
TEXT_STARTED = "Analysing"
TEXT_COMPLETE = "Complete:upgraded"
TEXT_FAILED_PREFIX = "Fail:"
TEXT_REPROCESS = "Ready to be reanalyzed"
TEXT_DELETED = "Deleted"

# --- fixed values: folder and file names below the indices folder ---------------------------
STAR_FOLDER = "STAR"
BOWTIE_FOLDER = "bowtie"
ANNOTATION_FOLDER = "annotations"
CHROM_LENGTH_FILE = "chrNameLength.txt"
ANNOTATION_FILE = "refgene.tsv"

# --- fixed values: settings keys read by the path columns -----------------------------------
SETTING_KEYS = ("wardrobe", "preliminary", "upload", "indices", "maxthreads", "experimentsdb")

# --- fixed values: loader name -> result file name, '{}' stands for the uid -----------------
RESULT_FILES = {
    "upload_macs2_fragment_stat": "{}_fragment_stat.tsv",
    "upload_iaintersect_result": "{}_macs_peaks_iaintersect.tsv",
    "upload_get_stat": "{}.stat",
    "upload_atdp": "{}_atdp.tsv",
    "upload_bigwig": "{}.bigWig",
    "upload_bigwig_upstream": "{}_upstream.bigWig",
    "upload_bigwig_downstream": "{}_downstream.bigWig",
    "upload_rpkm": "{}.isoforms.csv",
    "upload_folder_size": "upload_folder_size",
    "delete_files": "{}*.fastq",
}

# --- fixed values: coverage loaders -> (strand, browser table suffix) -----------------------
COVERAGE_TRACKS = {
    "upload_bigwig": (None, "_f_wtrack"),
    "upload_bigwig_upstream": ("+", "_upstream_f_wtrack"),
    "upload_bigwig_downstream": ("-", "_downstream_f_wtrack"),
}

# --- fixed values: loaders each experiment family runs, in order ----------------------------
RULES_DNA = (
    "upload_macs2_fragment_stat", "upload_iaintersect_result", "upload_get_stat",
    "upload_atdp", "upload_bigwig", "upload_folder_size", "delete_files",
)
RULES_RNA = ("upload_bigwig", "upload_get_stat", "upload_rpkm", "upload_folder_size", "delete_files")
RULES_RNA_STRANDED = (
    "upload_bigwig_upstream", "upload_bigwig_downstream", "upload_get_stat",
    "upload_rpkm", "upload_folder_size", "delete_files",
)

# --- fixed values: experiment types, (etype, workflow, inserted when absent) ----------------
EXPERIMENT_TYPES = (
    ("RNA-Seq", "rnaseq-se.cwl", False),
    ("RNA-Seq pair", "rnaseq-pe.cwl", False),
    ("RNA-Seq dUTP", "rnaseq-se-dutp.cwl", False),
    ("RNA-Seq dUTP Mitochondrial", "rnaseq-se-dutp-mitochondrial.cwl", True),
    ("RNA-Seq dUTP pair Mitochondrial", "rnaseq-pe-dutp-mitochondrial.cwl", True),
    ("RNA-Seq dUTP pair", "rnaseq-pe-dutp.cwl", False),
    ("DNA-Seq", "chipseq-se.cwl", False),
    ("DNA-Seq pair", "chipseq-pe.cwl", False),
    ("DNA-Seq Trim Galore", "trim-chipseq-se.cwl", True),
    ("DNA-Seq pair Trim Galore", "trim-chipseq-pe.cwl", True),
    ("RNA-Seq Trim Galore", "trim-rnaseq-se.cwl", True),
    ("RNA-Seq pair Trim Galore", "trim-rnaseq-pe.cwl", True),
    ("RNA-Seq dUTP Trim Galore", "trim-rnaseq-se-dutp.cwl", True),
    ("RNA-Seq dUTP pair Trim Galore", "trim-rnaseq-pe-dutp.cwl", True),
)

# --- fixed values: job template entries, (job key, kind, placeholder text) ------------------
# kind: an EDAM format number for a File, "dir" for a Directory, "text" quoted, "raw" unquoted
FASTQ_SINGLE = (("fastq_file", "1930", "{fastq_file_upstream}"),)
FASTQ_PAIRED = (
    ("fastq_file_upstream", "1930", "{fastq_file_upstream}"),
    ("fastq_file_downstream", "1930", "{fastq_file_downstream}"),
)
STAR_ENTRY = (("star_indices_folder", "dir", "{star_indices_folder}"),)
STAR_MITO_ENTRY = (("star_indices_folder_mitochondrial", "dir", "{star_indices_folder}-mitochondrial"),)
RNA_ENTRIES = (
    ("bowtie_indices_folder", "dir", "{bowtie_indices_folder_ribo}"),
    ("chrom_length_file", "2330", "{chrom_length}"),
    ("annotation_file", "3475", "{annotation_input_file}"),
    ("exclude_chr", "text", "{exclude_chr}"),
    ("clip_3p_end", "raw", "{clip_3p_end}"),
    ("clip_5p_end", "raw", "{clip_5p_end}"),
    ("threads", "raw", "{threads}"),
    ("output_folder", "text", "{output_folder}"),
    ("uid", "text", "{uid}"),
)
DNA_ENTRIES = (
    ("indices_folder", "dir", "{bowtie_indices_folder}"),
    ("annotation_file", "3475", "{annotation_input_file}"),
    ("clip_3p_end", "raw", "{clip_3p_end}"),
    ("clip_5p_end", "raw", "{clip_5p_end}"),
    ("threads", "raw", "{threads}"),
    ("remove_duplicates", "text", "{remove_duplicates}"),
    ("control_file", "2572", "{control_file}"),
    ("exp_fragment_size", "raw", "{exp_fragment_size}"),
    ("force_fragment_size", "text", "{force_fragment_size}"),
    ("broad_peak", "text", "{broad_peak}"),
    ("chrom_length", "2330", "{chrom_length}"),
    ("genome_size", "text", "{genome_size}"),
    ("output_folder", "text", "{output_folder}"),
    ("uid", "text", "{uid}"),
)
EDAM_FORMAT = "http://edamontology.org/format_"

# --- fixed values: promoter size used when an experiment names none --------------------------
DEFAULT_PROMOTER = 1000

# --- fixed values: how a url is routed, first match wins -------------------------------------
ROUTE_ARCHIVE = r"^(GSM|SR[ARX])[0-9]+( (GSM|SR[ARX])[0-9]+)*$"
ROUTE_URL = r"^https?://|^s?ftp://|^-"
ROUTE_COPY = r"^[0-9]+( [0-9]+)*$"

# --- fixed values: file types a download may have, and what a failed one says ----------------
DOWNLOAD_TYPES = ("bzip2", "gzip", "Zip", "ASCII")
TEXT_UNKNOWN_TYPE = "Error: file type unknown"
TEXT_NOT_FASTQ = "Error: not a fastq"
TEXT_BAD_FILTER = "Error: Bad filter"
TEXT_NO_LOCAL = "Skip local: File not found 0"

# --- fixed values: objects removed with an experiment ----------------------------------------
BROWSER_TABLE_SUFFIXES = ("_wtrack", "_islands", "_f_wtrack", "_upstream_f_wtrack", "_downstream_f_wtrack")
BROWSER_VIEW_SUFFIXES = ("_islands",)
RESULT_TABLE_SUFFIXES = ("_islands", "_atdp", "_atdph", "_isoforms", "_genes", "_common_tss")
RESULT_VIEW_SUFFIXES = ("_genes", "_common_tss")

# --- fixed values: browser views, (genome database, prefix of genome.db it shows) ------------
GENOME_VIEWS = (
    ("hg19", "hg"), ("mm10", "mm"), ("dm3", "dm"), ("rn5", "rn"), ("rheMac8", "rheMac8"),
    ("xenLae9", "xenLae9"), ("xenTro3", "xenTro"), ("xenTro7_1", "xenTro7"), ("xenTro9", "xenTro9"),
)
# views that show stranded RNA coverage as a plain bedGraph
PLAIN_BEDGRAPH_VIEWS = ("rn5",)

# --- fixed values: browser tracks of one experiment -------------------------------------------
# (suffix, shown for, type, visibility, priority, colour, alternative colour, canPack, settings)
# {b} is the uid with '-' as '_', {g} the experiment group; one settings line per entry
BLUE = (30, 70, 150)
GREEN = (30, 150, 70)
NAVY = (0, 30, 100)
TRACKS = (
    ("_wtrack", "rna_stranded", "PbedGraph 4", 0, 10, BLUE, BLUE, 0,
     ("autoScale on", "windowingFunction maximum")),
    ("_wtrack", "rna_plain", "bedGraph 4", 0, 10, BLUE, BLUE, 0,
     ("autoScale on", "windowingFunction maximum")),
    ("_f_wtrack", "rna_unstranded", "bigWig", 0, 2, BLUE, BLUE, 0,
     ("track {b}_f_wtrack", "autoScale on", "visibility hide", "windowingFunction maximum")),
    ("_multi_f_wtrack", "rna_dutp", "bigWig", 0, 2, BLUE, BLUE, 0,
     ("track {b}_multi_f_wtrack", "group {g}", "container multiWig", "autoScale on",
      "visibility hide", "windowingFunction maximum")),
    ("_upstream_f_wtrack", "rna_dutp", "bigWig", 0, 2, BLUE, GREEN, 0,
     ("track {b}_upstream_f_wtrack", "parent {b}_multi_f_wtrack")),
    ("_downstream_f_wtrack", "rna_dutp", "bigWig", 0, 2, BLUE, GREEN, 0,
     ("track {b}_downstream_f_wtrack", "parent {b}_multi_f_wtrack")),
    ("_grp", "dna", "bed 4 +", 0, 10, BLUE, BLUE, 0,
     ("compositeTrack on", "visibility hide",
      "subGroup1 view Views GCVRG=GenomeCoverage ILNDS=Islands", "group {g}", "track {b}_grp")),
    ("_gcvrg", "dna", "bedGraph 4", 2, 1, BLUE, BLUE, 0,
     ("parent {b}_grp", "track {b}_gcvrg", "view GCVRG", "visibility full")),
    ("_ilnds", "dna", "bed 4 +", 1, 1, BLUE, BLUE, 0,
     ("parent {b}_grp", "track {b}_ilnds", "view ILNDS", "visibility dense")),
    ("_wtrack", "dna", "bedGraph 4", 2, 1, BLUE, BLUE, 0,
     ("parent {b}_gcvrg", "track {b}_wtrack", "subGroups view=GCVRG", "autoScale on",
      "visibility full", "windowingFunction maximum")),
    ("_islands", "dna", "bed 4 +", 1, 3, NAVY, BLUE, 1,
     ("parent {b}_ilnds", "track {b}_islands", "subGroups view=ILNDS", "visibility dense")),
    ("_f_wtrack", "dna", "bigWig", 2, 2, BLUE, BLUE, 0,
     ("parent {b}_gcvrg", "track {b}_f_wtrack", "subGroups view=GCVRG", "autoScale on",
      "visibility full", "windowingFunction maximum")),
)
