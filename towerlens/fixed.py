"""The column names, code maps and parameters of the cell and subscriber tables.

They are parameters everywhere in the library; these are the values the known tables use.
"""

# KPI columns of the cell table, by network layer. The first of each list is the
# availability column, which does not follow the layer pattern and is left out of layer scoring.
KPI_2G = [
    "CELL_AVAILABILITY_2G",
    "CSSR_2G",
    "PSSR_2G",
    "TBF_DROP_RATE_2G",
    "TCH_DROP_RATE_2G",
]
KPI_3G = [
    "CELL_AVAILABILITY_3G",
    "CSSR_3G",
    "HSPDSCH_CODE_UTIL_3G",
    "NODEB_CNBAP_LOAD_HARDWARE",
    "PROC_LOAD_3G",
    "PSSR_3G",
    "RAB_CS_BLOCKING_RATE_3G",
    "RAB_CS_DROP_RATE_3G",
    "RAB_PS_BLOCKING_RATE_3G",
    "RAB_PS_DROP_RATE_3G",
    "RRC_BLOCKING_RATE_3G",
    "RTWP_3G",
    "SHO_FACTOR",
    "UTIL_BRD_CPU_3G",
    "UTIL_CE_DL_3G",
    "UTIL_CE_HW_DL_3G",
    "UTIL_CE_UL_3G",
    "UTIL_SUBUNITS_3G",
    "TOTAL_DL_VOLUME_3G",
    "TOTAL_UL_VOLUME_3G",
]
KPI_4G = [
    "CELL_AVAILABILITY_4G",
    "ERAB_PS_BLOCKING_RATE_LTE",
    "ERAB_PS_BLOCKING_RATE_PLMN_LTE",
    "ERAB_PS_DROP_RATE_LTE",
    "PART_CQI_QPSK_LTE",
    "PART_MCS_QPSK_LTE",
    "PSSR_LTE",
    "RBU_AVAIL_DL",
    "RBU_AVAIL_DL_LTE",
    "RBU_AVAIL_UL",
    "RBU_OTHER_DL",
    "RBU_OTHER_UL",
    "RBU_OWN_DL",
    "RBU_OWN_UL",
    "RRC_BLOCKING_RATE_LTE",
    "UL_VOLUME_LTE",
    "DL_VOLUME_LTE",
]

# Columns dropped from the 3G and 4G tables for their missing share, and from the
# 4G table for their few distinct values.
MOSTLY_MISSING_3G = [
    "PROC_LOAD_3G",
    "UTIL_SUBUNITS_3G",
    "UTIL_CE_UL_3G",
    "UTIL_CE_HW_DL_3G",
    "UTIL_BRD_CPU_3G",
    "HSPDSCH_CODE_UTIL_3G",
    "RTWP_3G",
    "NODEB_CNBAP_LOAD_HARDWARE",
    "RAB_PS_BLOCKING_RATE_3G",
    "RAB_CS_BLOCKING_RATE_3G",
    "RRC_BLOCKING_RATE_3G",
]
MOSTLY_MISSING_4G = ["RBU_AVAIL_DL_LTE", "CELL_AVAILABILITY_4G", "RBU_OTHER_UL", "RBU_OTHER_DL"]
FEW_VALUES_4G = ["RBU_AVAIL_UL", "RBU_AVAIL_DL", "PSSR_LTE"]

# Layers from the slowest to the fastest, and the layer behind each device code.
LAYERS = ["2G", "3G", "4G"]
DEVICE_LAYER = {1: "3G", 2: "4G", 3: "2G"}

# Formats and parameters.
FIELD_SEPARATOR = ";"
YEAR_SUFFIX = ".02"
FIRST_YEAR_OF_1900S = "69"
TOP_CELLS = 30
HISTOGRAM_BINS = 20
SAMPLE_ROWS = 500
PRELIMINARY_PERCENT = 40

KPI_BY_LAYER = {"2G": KPI_2G, "3G": KPI_3G, "4G": KPI_4G}
SCORED_BY_LAYER = {layer: columns[1:] for layer, columns in KPI_BY_LAYER.items()}
KPI_COLUMNS = KPI_2G + KPI_3G + KPI_4G
