"""Reference data the reports are driven by.

Everything in this module is a fixed value that has to equal the original
warehouse's seed rows for the reports to come out the same: region, area and
province dimensions, the profit-and-loss line tree, the allocation methods
and the account selectors of each allocated line.  They are small, bounded
tables (at most a few hundred rows), so they are built on the driver and
broadcast into joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from branchbook.sources import schemas as S
from branchbook.sources.local import local_table

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the original seed data.
# ---------------------------------------------------------------------------

HEAD_AREA = "A"          # area code of the head office in the area dimension
HEAD_POSTING_AREA = "00"  # area part of an analysis code booked at head office

# (region_id, region_name)
REGIONS = [
    ("00", "Trụ sở chính"),
    ("01", "Miền Bắc"),
    ("02", "Miền Trung"),
    ("03", "Miền Nam"),
]

# (area_code, area_name, region_id)
AREAS = [
    ("A", "Hội Sở", "00"),
    ("B", "Đông Bắc Bộ", "01"),
    ("C", "Tây Bắc Bộ", "01"),
    ("D", "Đồng Bằng Sông Hồng", "01"),
    ("E", "Bắc Trung Bộ", "02"),
    ("F", "Nam Trung Bộ", "02"),
    ("G", "Tây Nam Bộ", "03"),
    ("H", "Đông Nam Bộ", "03"),
]

# (province_id, province_name, area_code)
PROVINCES = [
    ("00", "Hội Sở", "A"),
    ("01", "An Giang", "G"),
    ("02", "Bắc Giang", "B"),
    ("03", "Bắc Kạn", "B"),
    ("04", "Bạc Liêu", "G"),
    ("05", "Bắc Ninh", "D"),
    ("06", "Bến Tre", "G"),
    ("07", "Bình Định", "F"),
    ("08", "Bình Dương", "H"),
    ("09", "Bình Phước", "H"),
    ("10", "Bình Thuận", "F"),
    ("11", "Cà Mau", "G"),
    ("12", "Cần Thơ", "G"),
    ("13", "Cao Bằng", "B"),
    ("14", "Đà Nẵng", "F"),
    ("15", "Đắk Lắk", "F"),
    ("16", "Đắk Nông", "F"),
    ("17", "Điện Biên", "C"),
    ("18", "Đồng Nai", "H"),
    ("19", "Đồng Tháp", "G"),
    ("20", "Gia Lai", "F"),
    ("21", "Hà Giang", "B"),
    ("22", "Hà Nam", "D"),
    ("23", "Hà Nội", "D"),
    ("24", "Hà Tĩnh", "E"),
    ("25", "Hải Dương", "D"),
    ("26", "Hải Phòng", "D"),
    ("27", "Hậu Giang", "G"),
    ("28", "Hồ Chí Minh", "H"),
    ("29", "Hòa Bình", "C"),
    ("30", "Hưng Yên", "D"),
    ("31", "Khánh Hòa", "F"),
    ("32", "Kiên Giang", "G"),
    ("33", "Kon Tum", "F"),
    ("34", "Lai Châu", "C"),
    ("35", "Lâm Đồng", "F"),
    ("36", "Lạng Sơn", "B"),
    ("37", "Lào Cai", "C"),
    ("38", "Long An", "G"),
    ("39", "Nam Định", "D"),
    ("40", "Nghệ An", "E"),
    ("41", "Ninh Bình", "D"),
    ("42", "Ninh Thuận", "F"),
    ("43", "Phú Thọ", "B"),
    ("44", "Phú Yên", "F"),
    ("45", "Quảng Bình", "E"),
    ("46", "Quảng Nam", "F"),
    ("47", "Quảng Ngãi", "F"),
    ("48", "Quảng Ninh", "B"),
    ("49", "Quảng Trị", "E"),
    ("50", "Sóc Trăng", "G"),
    ("51", "Sơn La", "C"),
    ("52", "Tây Ninh", "H"),
    ("53", "Thái Bình", "D"),
    ("54", "Thái Nguyên", "B"),
    ("55", "Thanh Hóa", "E"),
    ("56", "Huế", "E"),
    ("57", "Tiền Giang", "G"),
    ("58", "Trà Vinh", "G"),
    ("59", "Tuyên Quang", "B"),
    ("60", "Vĩnh Long", "G"),
    ("61", "Vĩnh Phúc", "D"),
    ("62", "Bà Rịa - Vũng Tàu", "H"),
    ("63", "Yên Bái", "C"),
]

# P&L tree: (pnl_id, pnl_code, pnl_name, pnl_parent_id, pnl_level, sortorder).
# The ids are pinned: the allocation and rollup steps refer to them by number.
PNL_TREE = [
    (1, "P1", "A. Lợi nhuận trước thuế", -1, 0, 1000000),
    (2, "P1_01", "1.Thu nhập từ hoạt động thẻ", 20, 1, 1010000),
    (3, "P1_01_01", "Lãi trong hạn", 2, 2, 1010100),
    (4, "P1_01_02", "Lãi quá hạn", 2, 2, 1010200),
    (5, "P1_01_03", "Phí Bảo hiểm", 2, 2, 1010300),
    (6, "P1_01_04", "Phí tăng hạn mức", 2, 2, 1010400),
    (7, "P1_01_05", "Phí thanh toán chậm, thu từ ngoại bảng, khác", 2, 2, 1010500),
    (8, "P1_02", "2.Chi phí thuần KDV", 20, 1, 1020000),
    (9, "P1_02_01", "DT Nguồn vốn", 8, 2, 1020100),
    (10, "P1_02_02", "CP vốn TT 2", 8, 2, 1020200),
    (11, "P1_02_03", "CP vốn TT 1", 8, 2, 1020300),
    (12, "P1_02_04", "CP vốn CCTG", 8, 2, 1020400),
    (13, "P1_03", "3.Chi phí thuần hoạt động khác", 20, 1, 1030000),
    (14, "P1_03_01", "DT Fintech", 13, 2, 1030100),
    (15, "P1_03_02", "DT tiểu thương, cá nhân", 13, 2, 1030200),
    (16, "P1_03_03", "DT Kinh doanh", 13, 2, 1030300),
    (17, "P1_03_04", "CP hoa hồng", 13, 2, 1030400),
    (18, "P1_03_05", "CP thuần KD khác", 13, 2, 1030500),
    (19, "P1_03_06", "CP hợp tác kd tàu (net)", 13, 2, 1030600),
    (20, "P1_04", "4.Tổng thu nhập hoạt động", 1, 1, 1040000),
    (21, "P1_05", "5.Tổng chi phí hoạt động", 1, 1, 1050000),
    (22, "P1_05_01", "CP thuế, phí", 21, 2, 1050100),
    (23, "P1_05_02", "CP nhân viên", 21, 2, 1050200),
    (24, "P1_05_03", "CP quản lý", 21, 2, 1050300),
    (25, "P1_05_04", "CP tài sản", 21, 2, 1050400),
    (26, "P1_06", "6.Chi phí dự phòng", 1, 1, 1060000),
    (27, "P2", "B. Số lượng nhân sự (Sale Manager)", -1, 0, 2000000),
    (28, "P3", "C. Chỉ số tài chính", -1, 0, 3000000),
    (29, "P3_01", "CIR (%)", 28, 1, 3001000),
    (30, "P3_02", "Margin (%)", 28, 1, 3002000),
    (31, "P3_03", "Hiệu suất trên/vốn (%)", 28, 1, 3003000),
    (32, "P3_04", "Hiệu suất BQ/ Nhân sự", 28, 1, 3004000),
]

# Allocation methods: (method_code, method_name) as written on the data rows,
# then the name written on the head-office zero rows (differs for 5 of 7).
METHODS = [
    ("AWO", "Phân bổ về từng KV theo DNCK bình quân sau WO"),
    ("AWO_GR1", "Phân bổ về từng KV theo DNCK bình quân sau WO của nhóm 1"),
    ("AWO_GR2", "Phân bổ về từng KV theo DNCK bình quân sau WO của nhóm 2"),
    ("AWO_GR2_5", "Phân bổ về từng KV theo DNCK bình quân sau WO của nhóm 2 đến nhóm 5"),
    ("BWO_GR2_5", "Phân bổ về từng KV theo DNCK bình quân trước WO của nhóm 2 đến nhóm 5"),
    ("SM_COUNT", "Phân bổ theo số lượng SM trong khu vực"),
    ("WO_PSDN", "Phân bổ về từng KV theo số lượng thẻ phát sinh dư nợ "),
]
HEAD_METHOD_NAMES = [
    ("AWO", "Phân bổ về từng KV theo DNCK bình quân sau WO"),
    ("AWO_GR1", "Phân bổ về từng KV theo DNCK bình quân sau WO nhóm 1"),
    ("AWO_GR2", "Phân bổ về từng KV theo DNCK bình quân sau WO nhóm 2"),
    ("AWO_GR2_5", "Phân bổ về từng KV theo DNCK bình quân sau WO nhóm 2-5"),
    ("BWO_GR2_5", "Phân bổ về từng KV theo DNCK bình quân trước WO nhóm 2-5"),
    ("SM_COUNT", "Phân bổ theo số lượng SM trong khu vực"),
    ("WO_PSDN", "Phân bổ theo số lượng thẻ phát sinh dư nợ"),
]

# Allocated lines: pnl_id -> (method_code, selector kind, selector values).
# kind "code" matches account_code exactly; kind "prefix" matches its first
# characters.  Lines 9, 14, 15, 19 and 28 carry the original's placeholder
# values, which match no account, so those lines come out as NULL rows.
ALLOCATED_LINES = {
    3: ("AWO_GR1", "code", ["702000030002", "702000030001", "702000030102"]),
    4: ("AWO_GR2", "code", ["702000030012", "702000030112"]),
    5: ("WO_PSDN", "code", ["716000000001"]),
    6: ("AWO_GR1", "code", ["719000030002"]),
    7: ("AWO_GR2_5", "code", ["719000030003", "719000030103", "790000030003",
                              "790000030103", "790000030004", "790000030104"]),
    9: ("AWO", "code", ["Account_id"]),
    10: ("AWO", "code", ["803000000001"]),
    11: ("AWO", "code", ["802000000002", "802000000003", "802014000001", "802037000001"]),
    12: ("AWO", "code", ["801000000001", "802000000001"]),
    14: ("AWO", "code", ["<nếu có GL code>"]),
    15: ("AWO", "code", ["<nếu có GL code>"]),
    16: ("AWO", "code", ["702000010001", "702000010002", "704000000001", "705000000001",
                         "709000000001", "714000000002", "714000000003", "714037000001",
                         "714000000004", "714014000001", "715000000001", "715037000001",
                         "719000000001", "709000000101", "719000000101"]),
    17: ("AWO", "code", ["816000000001", "816000000002", "816000000003"]),
    18: ("AWO", "code", ["809000000002", "809000000001", "811000000001", "811000000102",
                         "811000000002", "811014000001", "811037000001", "811039000001",
                         "811041000001", "815000000001", "819000000002", "819000000003",
                         "819000000001", "790000000003", "790000050101", "790000000101",
                         "790037000001", "849000000001", "899000000003", "899000000002",
                         "811000000101", "819000060001"]),
    19: ("AWO", "code", ["<nếu có GL code>"]),
    22: ("SM_COUNT", "code", ["831000000001", "831000000002", "832000000101",
                              "832000000001", "831000000102"]),
    23: ("SM_COUNT", "prefix", ["85"]),
    24: ("SM_COUNT", "prefix", ["86"]),
    25: ("SM_COUNT", "prefix", ["87"]),
    26: ("BWO_GR2_5", "code", ["790000050001", "882200050001", "790000030001",
                               "882200030001", "790000000001", "790000020101",
                               "882200000001", "882200050101", "882200020101",
                               "882200060001", "790000050101", "882200030101"]),
    28: ("AWO", "code", ["<nếu có GL code>"]),
}

# Lines filled by summing other lines, in the order the original computes
# them; each sums the rows whose tree parent is the line.
ROLLUP_LINES = [2, 8, 13, 20, 21, 1]
HEADCOUNT_LINE = 27

# Ratio lines: id -> (numerator ids, denominator ids, scale factor)
RATIO_LINES = {
    29: ([21], [20], 100),
    30: ([1], [2, 9, 14, 15, 16], 100),
    31: ([1], [8], 100),
    32: ([1], [27], 1),
}

# Heat-map KPI labels, in output order, and the report column each reads.
HEAT_MAP_KPIS = [
    ("1.Tiền giải ngân", "ltn_avg"),
    ("2.PSDN", "psdn_avg"),
    ("3.Tỉ lệ phê duyệt", "approval_rate_avg"),
    ("4.NPL trước WO", "npl_truoc_wo_luy_ke"),
    ("5.CIR", "cir"),
]

# Lines and the area excluded by the month-over-month column chart.
COL_CHART_LINES = [1, 20, 21, 26]

# ---------------------------------------------------------------------------
# Derived helpers (computed from the fixed values above).
# ---------------------------------------------------------------------------


def rollup_closure() -> list[tuple[int, int]]:
    """(leaf_id, ancestor_id) for every rolled-up ancestor of a stored line.

    A rolled-up line is the sum of its children, and children may themselves
    be rolled up, so the sum equals the sum over the allocated leaves below
    it.  Only the lines in ROLLUP_LINES are rolled up (28 is filled by its own
    placeholder allocation, never by its children).
    """
    parent = {row[0]: row[3] for row in PNL_TREE}
    rolled = set(ROLLUP_LINES)
    pairs = []
    for leaf in ALLOCATED_LINES:
        node = parent.get(leaf, -1)
        while node in rolled:
            pairs.append((leaf, node))
            node = parent.get(node, -1)
    return sorted(pairs)


def regions_df(spark: SparkSession) -> DataFrame:
    return local_table(spark, REGIONS, S.DIM_REGION)


def areas_df(spark: SparkSession) -> DataFrame:
    return local_table(spark, AREAS, S.DIM_AREA)


def provinces_df(spark: SparkSession) -> DataFrame:
    return local_table(spark, PROVINCES, S.DIM_PROVINCE)


def pnl_tree_df(spark: SparkSession) -> DataFrame:
    return local_table(spark, PNL_TREE, S.DIM_PNL)


def line_catalog_df(spark: SparkSession) -> DataFrame:
    """One row per allocated line: (pnl_id, method_code)."""
    rows = [(pid, spec[0]) for pid, spec in sorted(ALLOCATED_LINES.items())]
    return local_table(spark, rows, "pnl_id int, method_code string")


def line_selector_df(spark: SparkSession) -> DataFrame:
    """Bridge account selector -> line (many-to-many).

    ``match_key`` is what a posting is joined on: the account code itself for
    exact selectors, ``'prefix:' || first-n-characters`` for prefix ones, so
    both kinds are answered by one equi-join (see allocation.posting_keys).
    """
    rows = []
    for pid, (_, kind, values) in sorted(ALLOCATED_LINES.items()):
        for v in values:
            key = v if kind == "code" else f"prefix:{v}"
            rows.append((pid, kind, v, key))
    return local_table(spark, rows, "pnl_id int, kind string, selector string, match_key string")


def prefix_lengths() -> list[int]:
    return sorted({len(v) for _, kind, vals in ALLOCATED_LINES.values() if kind == "prefix" for v in vals})


def closure_df(spark: SparkSession) -> DataFrame:
    return local_table(spark, rollup_closure(), "leaf_id int, ancestor_id int")


def heat_map_kpis() -> list[tuple[str, str]]:
    return list(HEAT_MAP_KPIS)

