from .csv_files import read_sales_csv, write_csv
from .raw import conform
from .staging import staged, written_once
from .star import clean_star_sales, star_sales
from .tables import publish, read_sales, save_sales_table, write_sales

__all__ = [
    "clean_star_sales",
    "conform",
    "publish",
    "read_sales",
    "read_sales_csv",
    "save_sales_table",
    "staged",
    "star_sales",
    "write_csv",
    "write_sales",
    "written_once",
]
