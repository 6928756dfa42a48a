"""The small set of books that several tests use, and how results are compared."""

# Two months of a small wholesaler, made up for these tests.
LEDGER_ROWS = """
C-1|Harbour Bakery|Customer
C-2|Nordlicht Cafe|Customer
C-3|Olive & Vine|Customer
C-4|Paper Lantern|Customer
S-1|Millstone Flour|Supplier
S-2|Ridge Dairy|Supplier
S-3|Tin & Twine|Supplier
"""

SALES_ROWS = """
2023-05-02|A-1|Harbour Bakery|1200|60|Wire
2023-05-09|A-2|Nordlicht Cafe|800|40|Cash
2023-05-20|A-3|Harbour Bakery|300|15|Wire
2023-06-04|A-4|Olive & Vine|2500|125|Card
2023-06-11|A-5|Paper Lantern|450|22.50|Cash
2023-06-30|A-6|Nordlicht Cafe|1000|50|Wire
"""

PURCHASE_ROWS = """
2023-05-05|B-1|Millstone Flour|700|35|Wire
2023-05-25|B-2|Ridge Dairy|400|20|Cash
2023-06-08|B-3|Millstone Flour|650|32.50|Wire
2023-06-19|B-4|Tin & Twine|90|4.50|Cash
"""

BANK_ROWS = """
2023-05-10|K-1|Harbour Bakery payment|1500|credit|Wire
2023-05-12|K-2|Millstone Flour purchase|500|debit|Wire
2023-05-28|K-3|Nordlicht Cafe payment|900|credit|Cash
2023-06-06|K-4|Olive & Vine payment|3000|credit|Card
2023-06-15|K-5|Ridge Dairy purchase|400|debit|Cash
2023-06-21|K-6|Tin & Twine purchase|200|debit|Wire
2023-06-28|K-7|   Nordlicht Cafe payment   |1100|credit|Cash
"""


def rows_of(text):
    return [line.split("|") for line in text.strip("\n").splitlines()]


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
