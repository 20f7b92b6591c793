from shopscope.sources.tables import read_table, tpch_tables  # noqa: F401
from shopscope.sources.raw_view import raw_sales_from_tpch  # noqa: F401
from shopscope.sources.files import read_sales_files, read_rfm_file  # noqa: F401
