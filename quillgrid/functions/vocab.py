"""Word lists, glossaries and constants that results depend on."""

# Question words that the tokenizer drops.
STOPWORDS = (
    "a", "an", "the", "is", "are", "was", "were", "be", "been", "being", "do", "does", "did",
    "how", "what", "which", "who", "where", "when", "why", "from", "in", "on", "at", "to", "of",
    "for", "and", "or", "all", "there", "have", "has", "had", "our",
)

# Abbreviation in a table or column name -> word.
GLOSSARY = {
    "cust": "customer", "mst": "master", "ord": "order", "txn": "transaction",
    "prod": "product", "emp": "employee", "rec": "record", "nm": "name", "cd": "code",
    "dt": "date", "amt": "amount", "qty": "quantity", "st": "state", "stat": "status",
    "inv": "invoice", "ln": "line", "pay": "payment", "ship": "shipment", "ret": "return",
    "wh": "warehouse", "stk": "stock", "mov": "movement", "supp": "supplier",
    "po": "purchase order", "grn": "goods receipt", "dept": "department",
    "desig": "designation", "attn": "attendance", "hdr": "header", "sal": "salary",
    "appr": "appraisal", "cat": "category", "disc": "discount", "promo": "promotion",
    "cpn": "coupon", "rev": "review", "tkt": "ticket", "msg": "message", "addr": "address",
    "regn": "region", "cntry": "country", "curr": "currency", "rt": "rate", "led": "ledger",
    "acct": "account", "bank": "bank", "asset": "asset", "veh": "vehicle", "fuel": "fuel",
    "usr": "user", "perm": "permission", "audit": "audit", "cfg": "config",
    "prm": "parameter", "notif": "notification", "eml": "email", "sms": "sms",
    "stg": "staging", "err": "error", "crtd": "created", "prc": "price", "unit": "unit",
    "city": "city", "brand": "brand", "budget": "budget", "trip": "trip", "route": "route",
    "role": "role", "job": "job", "sched": "schedule",
}

# Fixed values: (table, column, stored value) -> natural-language meanings.
VALUE_ALIASES = {
    ("cust_mst", "st_cd", "MH"): ["Maharashtra", "Maharashtra state"],
    ("cust_mst", "st_cd", "KA"): ["Karnataka", "Karnataka state"],
    ("cust_mst", "st_cd", "TN"): ["Tamil Nadu", "Tamil Nadu state"],
    ("cust_mst", "st_cd", "DL"): ["Delhi", "Delhi state"],
    ("prod_mst", "cat_cd", "ELEC"): ["electronics", "electronic products"],
    ("prod_mst", "cat_cd", "ACCS"): ["accessories", "product accessories"],
    ("prod_mst", "cat_cd", "FURN"): ["furniture", "office furniture"],
    ("emp_rec", "dept_cd", "SALES"): ["sales", "sales department"],
    ("emp_rec", "dept_cd", "TECH"): ["technology", "technology department", "tech department"],
    ("emp_rec", "dept_cd", "OPS"): ["operations", "operations department"],
    ("ord_txn", "stat_cd", "1"): ["pending", "pending order"],
    ("ord_txn", "stat_cd", "2"): ["processing", "in progress", "processing order"],
    ("ord_txn", "stat_cd", "3"): ["delivered", "delivered order", "completed delivery"],
    ("ord_txn", "stat_cd", "4"): ["cancelled", "canceled", "cancelled order"],
}

# Order status code -> label; any other code is "Other".
STATUS_LABELS = {1: "Pending", 2: "Processing", 3: "Delivered", 4: "Cancelled"}

# Seeds of the generated rows.
STATES = (
    ("MH", "Maharashtra", "WEST", ("Mumbai", "Pune", "Nagpur", "Nashik")),
    ("KA", "Karnataka", "SOUTH", ("Bengaluru", "Mysuru", "Mangaluru")),
    ("TN", "Tamil Nadu", "SOUTH", ("Chennai", "Coimbatore", "Madurai")),
    ("DL", "Delhi", "NORTH", ("New Delhi", "Dwarka", "Rohini")),
    ("GJ", "Gujarat", "WEST", ("Ahmedabad", "Surat", "Vadodara")),
    ("UP", "Uttar Pradesh", "NORTH", ("Lucknow", "Kanpur", "Noida")),
)
FIRST_NAMES = ("Aarav", "Anaya", "Ishaan", "Diya", "Kabir", "Meera", "Rohan", "Sara")
LAST_NAMES = ("Sharma", "Patel", "Iyer", "Reddy", "Verma", "Nair", "Das", "Khan")
PRODUCTS = (
    ("Laptop", "ELEC", 62000.0),
    ("Wireless Mouse", "ACCS", 799.0),
    ("Office Chair", "FURN", 8500.0),
    ("LED Monitor", "ELEC", 11500.0),
    ("Mechanical Keyboard", "ACCS", 4200.0),
    ("Desk Lamp", "FURN", 1800.0),
    ("USB-C Hub", "ELEC", 3200.0),
    ("Headphones", "ACCS", 5600.0),
)
DEPARTMENTS = ("SALES", "TECH", "OPS", "FINANCE", "SUPPORT", "HR")
STATUS_CYCLE = (1, 2, 3, 3, 3, 4)
DATE_START = "2020-01-01"
TARGET_ROWS = 5000
CORE_TARGETS = {"cust_mst": 5000, "prod_mst": 3000, "ord_txn": 12000, "emp_rec": 1500, "st_mst": 5000}

# Generated columns that refer to a parent table, and the parent.
PARENT_OF = {
    "cust_id": "cust_mst", "prod_id": "prod_mst", "ord_id": "ord_txn", "emp_id": "emp_rec",
    "supp_id": "supp_mst", "inv_id": "inv_hdr", "pay_id": "pay_txn", "ship_id": "ship_hdr",
    "po_id": "po_hdr", "grn_id": "grn_hdr", "wh_id": "wh_mst", "tkt_id": "tkt_hdr",
    "cart_id": "cart_hdr", "promo_id": "promo_mst", "veh_id": "veh_mst", "job_id": "job_sched",
    "usr_id": "usr_mst", "trip_id": "trip_log",
}

# Retrieval settings.
TOP_K_TABLES = 8
VALUE_CARDINALITY_LIMIT = 500
ABSTAIN_THRESHOLD = 0.81
VECTOR_WEIGHT = 0.70
LEXICAL_WEIGHT = 0.30
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25

# Evaluation, paging and time limits.
HARMLESS_EXTRA_CELLS = 12
PAGE_SIZE = 100
PREVIEW_ROWS = 20
COOLDOWN_SECONDS = 60
EXPIRY_MINUTES = 5
ERROR_TEXT_LENGTH = 120
EMAIL_PATTERN = r"[^@\s]+@[^@\s]+\.[^@\s]+"

# Column names of generated tables with a role of their own, and the values of
# short cycles. The first rule that fits a name decides, so some names of the last list are
# already taken by an earlier one.
STATE_COLUMNS = ("st_cd", "state_code")
REGION_COLUMNS = ("regn_cd", "region", "region_cd")
COUNTRY_COLUMNS = ("cntry_cd", "country_cd")
CATEGORY_COLUMNS = ("cat_cd", "category")
DEPARTMENT_COLUMNS = ("dept_cd", "department")
ROLE_COLUMNS = ("role_cd",)
FLAG_COLUMNS = ("stat_cd", "status", "proc_flg", "sent_flg", "actv_flg", "can_rd", "can_wr")
DATE_ENDINGS = ("_dt", "_ts")
DATE_COLUMNS = ("eff_dt", "valid_to", "att_dt", "recv_dt", "fill_dt", "sent_dt", "last_run")
MEASURE_PARTS = (
    "amt", "price", "rate", "sal", "budget", "gross", "ded", "net", "spent", "alloc", "wdv", "litres", "dist", "rating",
    "pct", "cap", "on_hand", "qty", "grade", "lvl", "min_sal",
)
LABEL_COLUMNS = (
    "mode_cd", "mov_typ", "sender_typ", "prio_cd", "chnl_cd", "acct_typ", "carrier_cd", "typ_cd", "rsn_cd", "lv_typ",
    "res_cd", "curr_cd", "cntry_cd", "actn", "tbl_nm", "subj", "line1", "body", "cmnt", "trk_no", "reg_no", "ref_no",
    "src_file", "modu_cd", "prm_cd", "prm_val", "to_city", "frm_city", "strt_ts", "end_ts", "last_run", "upd_dt", "mth",
    "fy", "cyc_yr",
)
REGIONS = ("WEST", "SOUTH", "NORTH", "EAST")
COUNTRIES = ("IN", "US", "SG", "AE")
ACCESS_ROLES = ("ADMIN", "ANALYST", "MANAGER", "STAFF")
FLAGS = ("1", "2", "3", "1", "1", "0")
