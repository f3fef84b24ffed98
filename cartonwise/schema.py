"""Column names and types of the line table, the export files and the contact table."""

from pyspark.sql import types as T

# Export headers and the columns they load into, in export order.
HEADERS = {
    "Area": "area",
    "Sub-Area": "sub_area",
    "Current Handover Date": "handover_date",
    "Origin Country": "origin_country",
    "Origin Port": "origin_port",
    "Supplier": "supplier",
    "Factory": "factory",
    "Destination PO": "destination_po",
    "Kimball": "kimball",
    "Colour Code": "colour_code",
    "Description": "description",
    "Size": "size",
    "PO Qty": "po_qty",
    "Carton Matrix Code": "carton_matrix_code",
    "Units Per Carton": "units_per_carton",
    "Outer Carton Length (mm)": "carton_length_mm",
    "Outer Carton Width (mm)": "carton_width_mm",
    "Outer Carton Height (mm)": "carton_height_mm",
    "Packaging Supplier": "packaging_supplier",
    "Updated Date": "updated_date",
    "Updated By": "updated_by",
    "Approved Date": "approved_date",
    "Approved By": "approved_by",
    "Packaging Confirmation Status": "packaging_status",
}
# Fixed value: the header a month extract gives the verdict.
VERDICT_HEADER = "Compliance Status"
# Without this header a file cannot be loaded; every other one may be absent.
MANDATORY_HEADER = "Carton Matrix Code"

INTEGER_COLUMNS = ("po_qty", "units_per_carton", "carton_length_mm", "carton_width_mm", "carton_height_mm")
TIME_COLUMNS = ("updated_date", "approved_date")

_TYPES = {
    **{c: T.IntegerType() for c in INTEGER_COLUMNS},
    **{c: T.TimestampType() for c in TIME_COLUMNS},
    "handover_date": T.DateType(),
    "cbm": T.DecimalType(10, 4),
    "density": T.DecimalType(10, 2),
}
# Columns of a loaded line in report order; source_file is last because the store is partitioned by it.
LINE_COLUMNS = (
    "area", "sub_area", "origin_country", "origin_port", "supplier", "factory", "destination_po", "kimball",
    "colour_code", "description", "size", "po_qty", "handover_date", "carton_matrix_code", "units_per_carton",
    "carton_length_mm", "carton_width_mm", "carton_height_mm", "packaging_supplier", "updated_date", "updated_by",
    "approved_date", "approved_by", "packaging_status", "carton_type", "cbm", "density", "compliance_status",
    "source_file",
)
LINES = T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in LINE_COLUMNS])

ALIASES = T.StructType([T.StructField("raw_name", T.StringType()), T.StructField("canonical_name", T.StringType())])
CONTACTS = T.StructType([T.StructField("supplier_name", T.StringType()), T.StructField("email", T.StringType())])

# Packaging statuses with a column of their own, and the two verdicts.
STATUSES = {"pending": "Pending", "approved": "Approved", "rejected": "Approval Rejected", "escalated": "Escalated"}
COMPLIANT = "Compliant"
NON_COMPLIANT = "Non-compliant"
