"""One object with every metric group."""

from __future__ import annotations

from datetime import date

from posmetrics.operators.adhoc import Adhoc
from posmetrics.operators.customers import Customers
from posmetrics.operators.employees import Employees
from posmetrics.operators.inventory import Inventory
from posmetrics.operators.listing import Listing
from posmetrics.operators.operations import Operations
from posmetrics.operators.products import Products
from posmetrics.operators.profitability import Profitability
from posmetrics.operators.revenue import Revenue
from posmetrics.operators.time_series import TimeSeries
from posmetrics.sources.tables import Tables


class Engine:
    """``Engine(tables).revenue.daily_revenue(days=7)`` and so on.

    ``as_of`` is the day the ``days`` windows end on; the current date by default.
    Every method returns a lazy DataFrame, scalars as one row and one column.
    """

    def __init__(self, tables: Tables, as_of: date | None = None):
        self.tables = tables
        self.revenue = Revenue(tables, as_of)
        self.products = Products(tables, as_of)
        self.customers = Customers(tables, as_of)
        self.employees = Employees(tables, as_of)
        self.operations = Operations(tables, as_of)
        self.time_series = TimeSeries(tables, as_of)
        self.profitability = Profitability(tables, as_of)
        self.inventory = Inventory(tables, as_of)
        self.adhoc = Adhoc(tables, as_of)
        self.listing = Listing(tables, as_of)
