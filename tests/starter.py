"""The starter rows of the small sales database."""

CUSTOMERS = [
    (101, "Rahul Verma", "MH", "Mumbai", "2023-04-12"),
    (102, "Priya Nair", "KA", "Bengaluru", "2024-01-08"),
    (103, "Amit Shah", "MH", "Pune", "2024-06-30"),
    (104, "Sneha Iyer", "TN", "Chennai", "2023-11-02"),
    (105, "Vikram Singh", "DL", "Delhi", "2025-02-14"),
    (106, "Kavya Reddy", "KA", "Mysuru", "2024-09-19"),
    (107, "Arjun Deshmukh", "MH", "Nagpur", "2025-05-05"),
]
PRODUCTS = [
    (1, "Laptop 14 inch", "ELEC", 62000.0),
    (2, "Wireless Mouse", "ACCS", 799.0),
    (3, "Office Chair", "FURN", 8500.0),
    (4, "LED Monitor 24", "ELEC", 11500.0),
    (5, "Mechanical Keyboard", "ACCS", 4200.0),
]
ORDERS = [
    (5001, 101, 1, 1, 62000.0, "2025-02-11", 3),
    (5002, 103, 2, 3, 2397.0, "2025-03-04", 3),
    (5003, 101, 4, 2, 23000.0, "2025-05-19", 2),
    (5004, 102, 3, 1, 8500.0, "2025-01-22", 3),
    (5005, 104, 1, 1, 62000.0, "2025-04-08", 1),
    (5006, 105, 5, 2, 8400.0, "2025-06-01", 3),
    (5007, 103, 4, 1, 11500.0, "2025-06-15", 4),
    (5008, 107, 1, 2, 124000.0, "2025-07-02", 3),
    (5009, 106, 2, 5, 3995.0, "2025-07-11", 2),
    (5010, 101, 3, 1, 8500.0, "2025-07-20", 1),
]
EMPLOYEES = [
    (1, "Meera Joshi", "SALES", 85000.0, "2021-06-01"),
    (2, "Rohit Kulkarni", "TECH", 120000.0, "2020-03-15"),
    (3, "Anita Rao", "SALES", 92000.0, "2022-08-09"),
    (4, "Sanjay Patil", "OPS", 67000.0, "2023-01-30"),
]


def frames(spark):
    return {
        "cust_mst": spark.createDataFrame(CUSTOMERS, "cust_id long, cust_nm string, st_cd string, city_nm string, crtd_dt string"),
        "prod_mst": spark.createDataFrame(PRODUCTS, "prod_id long, prod_nm string, cat_cd string, unit_prc double"),
        "ord_txn": spark.createDataFrame(ORDERS, "ord_id long, cust_id long, prod_id long, qty long, amt double, ord_dt string, stat_cd int"),
        "emp_rec": spark.createDataFrame(EMPLOYEES, "emp_id long, emp_nm string, dept_cd string, sal double, join_dt string"),
    }
