"""Small CSV extracts of all 20 raw tables, with the awkward values of real ones."""

from __future__ import annotations

import csv
import os

from schoolyard.sources.raw import RAW_COLUMNS

T0 = "2024-01-05 08:00:00"

ROWS: dict[str, list[tuple]] = {
    "crm_user": [
        ("U1", "Ana", "ana@x", "Account Manager", "true", T0, T0),
        ("U2", "Bia", "bia@x", "Admin", "true", T0, T0),
        ("U3", "Caio", "caio@x", "Sales Rep", "false", T0, T0),
        ("U4", "Davi", "davi@x", "CS Manager", "true", T0, T0),
        ("U5", "Eva", "eva@x", "CS Manager", "true", T0, T0),
    ],
    "crm_account": [
        ("A1", "Escola, Um", "Um SA", "01.438.889/9375-67", "School", "A9", "1", "Recife", "PE",
         "m", "s", "U1", "false", T0, T0),
        ("A2", "Dois", "Dois SA", "22.222.222/2222-22", "School", "", "", "", "SP", "m", "s",
         "U4", "false", T0, T0),
        ("A3", "Tres", "Tres SA", "33.333.333/3333-33", "School", "", "", "Rio", "RJ", "m", "s",
         "U5", "true", T0, T0),
        ("A9", "Rede", "Rede SA", "99.999.999/9999-99", "Network", "", "", "Rio", "RJ", "m", "s",
         "U1", "false", T0, T0),
    ],
    "crm_product": [("P1", "SKU-1", "Book", "B", "Kit", "true", T0)],
    "crm_service_contract": [
        ("K1", " Ct-2024-001 ", "c1", "A1", "U1", "Activated", "2024-01-01", "2024-12-31", "B",
         "100.50", "100.50", "0", "m", "false", T0, T0),
        ("K2", "ct-2024-002", "c2", "A2", "U2", "Cancelled", "2024-01-01", "2024-12-31", "B",
         "50", "50", "0", "m", "false", T0, T0),
        ("K3", "CT-2024-003", "c3", "A2", "U4", "Activated", "2024-02-01", "2024-12-31", "B",
         "10.10", "10.10", "0", "m", "true", T0, T0),
        ("K4", "CT-2023-004", "c4", "A9", "U4", "Activated", "2023-02-01", "2023-12-31", "B",
         "70", "70", "0", "m", "false", T0, T0),
    ],
    "crm_contract_line_item": [
        ("L1", "K1", "P1", "Kit", "1 EF", "seg", "3", "10.5", "0.1", "31.4", T0)
    ],
    "erp_a_salesperson": [("1", "Sal", "Sul", "Y"), ("2", "Sil", "Norte", "N"), ("3", "S", "N", "")],
    "erp_a_customer": [
        ("C1", "Um A", "01438889937567", "Olinda", "PE", "1", "e@x", "1", "2022-01-01", "2022-01-02"),
        ("C4", "Quatro A", "44444444444444", "Natal", "RN", "", "", "2", "2022-01-01", "2022-01-02"),
        ("C7", "Curto", "123", "Natal", "RN", "", "", "2", "2022-01-01", "2022-01-02"),
        ("C9", "Rede A", "99999999999999", "Rio", "RJ", "", "", "2", "2022-01-01", "2022-01-02"),
    ],
    "erp_a_sales_order": [
        ("10", "1010", "C4", "\tct-2024-001 ", "2024-03-05", "2024-04-01", "N", "O", "", "1",
         "2024-03-05", "2024-03-06"),
        ("11", "1011", "C4", "", "2024-03-20", "2024-04-01", "N", "C", "", "1", "2024-03-20",
         "2024-03-20"),
        ("12", "1012", "C1", "", "2024-04-02", "2024-05-01", "Y", "C", "", "2", "2024-04-02",
         "2024-04-02"),
        ("13", "1013", "C7", "", "2024-05-02", "2024-05-09", "N", "C", "", "2", "2024-05-02",
         "2024-05-02"),
    ],
    "erp_a_sales_order_item": [
        ("10", "1", "SKU-1", "Book", "2", "2", "0", "2024-03-06", "C", "10.25", "20.50"),
        ("10", "2", "SKU-2", "Pen", "1.5", "0", "1.5", "", "O", "2", "3"),
        ("12", "1", "SKU-1", "Book", "4", "0", "4", "2024-04-03", "O", "10", "40"),
        ("99", "1", "SKU-1", "Book", "1", "0", "1", "2024-04-03", "O", "1", "1"),
    ],
    "erp_a_delivery": [
        ("500", "1", "C4", "10", "2024-03-31", "C", "N", "2024-03-31"),
        ("501", "2", "C4", "10", "2024-04-01", "C", "Y", "2024-04-01"),
        ("502", "3", "C1", "12", "2204-12-31", "C", "N", "2024-04-01"),
        ("503", "4", "C1", "98", "2024-06-01", "O", "N", "2024-06-01"),
    ],
    "erp_a_invoice": [("700", "1", "C4", "10", "2024-03-31", "23.50", "1.20", "N", "2024-03-31")],
    "erp_b_vendedor": [("1", "Ven", "v@x", "Sul", "S"), ("2", "Dor", "d@x", "Norte", "N")],
    "erp_b_escola": [
        ("1", "Um B", "01 438 889 9375 67", "Olinda B", "PE", "b@x", "1", "2022-01-01", "2022-01-02"),
        ("6", "Seis B", "66666666666666", "Belem", "PA", "b@x", "2", "2022-01-01", "2022-01-02"),
    ],
    "erp_b_pedido": [
        ("10", "1", "Ct-2024-001", "2024-03-06", "2024-03-30", "entregue", "1", T0, T0),
        ("11", "6", "", "2024-04-07", "2024-04-30", "P", "1", T0, T0),
        ("12", "6", "", "2024-04-08", "2024-04-30", "cancelado", "1", T0, T0),
        ("13", "6", "", "2024-04-09", "2024-04-30", "", "1", T0, T0),
    ],
    "erp_b_item_pedido": [
        ("1", "10", "SKU-1", "Book", "3", "10.10", T0),
        ("2", "11", "SKU-1", "Book", "2", "7.25", T0),
        ("3", "12", "SKU-1", "Book", "1", "9.99", T0),
    ],
    "fin_nota_fiscal": [
        ("800", "N1", "1", "10", "01.438.889/9375-67", "Um", "2024-03-08", "30.30", "1", "7", "T",
         "X1", "2024-03-10", "2024-03-12", "entregue", "3", T0),
        ("801", "N2", "1", "11", "66666666666666", "Seis", "2024-04-10", "14.50", "1", "7", "T",
         "X2", "2024-04-12", "", "extraviado", "2", T0),
        ("802", "N3", "1", "12", "66666666666666", "Seis", "2024-04-11", "14.50", "1", "7", "T",
         "X3", "2024-04-12", "", "estranho", "", T0),
    ],
    "support_organization": [
        ("1", "Um S", "", "01438889937567", "", T0, T0),
        ("2", "Seis S", "", "66666666666666", "", T0, T0),
        ("3", "Sete S", "", "77777777777777", "", T0, T0),
        ("4", "Sem", "", "", "", T0, T0),
    ],
    "support_user": [("1", "Sup", "s@x", "1", "agent", "true", T0, T0)],
    "support_ticket": [
        ("1", "a", "one line", "solved", "low", "1", "2", "1", "10", "01.438.889/9375-67",
         "2024-03-01 10:00:00", T0, "2024-03-01 11:59:59"),
        ("2", "b", "say \"hi\"", "closed", "high", "1", "2", "1", "", "", "2024-03-02 10:00:00", T0,
         "2024-03-02 13:00:00"),
        ("3", "c", "", "open", "high", "1", "2", "3", "11", "", "2024-07-02 10:00:00", T0, ""),
        ("4", "d", "", "new", "urgent", "1", "2", "4", "12", "", "2024-07-03 10:00:00", T0, ""),
        ("5", "e", "", "new", "urgent", "1", "2", "", "999", "", "2024-08-03 10:00:00", T0, ""),
    ],
    "support_ticket_tag": [("1", "zeta"), ("1", "alfa"), ("2", ""), ("3", "x")],
}


def write(folder: str) -> str:
    for table, rows in ROWS.items():
        with open(os.path.join(folder, f"{table}.csv"), "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(RAW_COLUMNS[table].split())
            out.writerows(rows)
    return folder
