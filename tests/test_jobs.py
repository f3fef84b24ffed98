import json

import pytest
from line_rows import MAY, rows_of
from test_loading import BASE, write

from cartonwise.config import NoData
from cartonwise.functions.dates import shift_month
from cartonwise.jobs import Home, main


def test_a_month_from_files_to_reports(spark, tmp_path, capsys):
    days = [{"Current Handover Date": f"2026-05-{d:02d}", "Updated Date": f"2026-05-{d - d % 2:02d}",
             "Origin Country": "India", "Factory": f"F{d % 3}", "Destination PO": f"PO{d}", "PO Qty": "5",
             "Approved By": "alice"} for d in range(2, 20)]
    export = write(tmp_path / "in" / "May 1-15.csv", [BASE | d for d in days])
    emails = write(tmp_path / "emails.csv", [{"Supplier Name": "Acme", "Email": "a@x.com;b@x.com"}])
    home = Home(spark, str(tmp_path / "home"))
    main(["--home", home.path, "load", export])
    main(["--home", home.path, "import-contacts", emails])
    assert home.import_contacts(emails) == 1
    assert rows_of(home.contacts()) == [("acme", "a@x.com"), ("acme", "b@x.com")]
    for job in ("supplier-reports", "summary", "kpi", "extract", "all-supplier-data"):
        main(["--home", home.path, job])
    assert "1 reports" in capsys.readouterr().out
    top = spark.read.json(home.folder(MAY, "Summary_Report/top_suppliers")).first()
    assert (top.sl, top.supplier, top.factory_count, top.dest_po_count, top.rate) == (1, "ACME", 3, 18, 100.0)
    items = spark.read.json(home.folder(MAY, "Supplier_Reports"))
    assert items.where("section = 'transactions'").count() == 18
    assert json.loads(items.where("section = 'headline'").first().item)["band"] == "high"
    assert spark.read.option("header", True).csv(home.folder(MAY, "All_Supplier_Data")).count() == 18
    with pytest.raises(NoData):
        home.kpi(shift_month(MAY, -24))
    home.clear()
    assert home.store.read().count() == 0 and home.contacts().count() == 2
