"""A hand-made extract of 80 rows whose load has known counts, issues and report totals."""

from __future__ import annotations

import csv
from pathlib import Path

from dealmill.schemas import RAW_COLUMNS
from dealmill.sources.extracts import DEFAULT_TEMPLATE

ROWS: dict[str, list[list[str]]] = {
    "users": [
        ["U10", "Иван Петров", "sales_manager", "true", "Продажи", "u10@example.org"],
        ["U11", "Анна Соколова", "sales_manager", "true", "Продажи", "u11@example.org"],
        ["U12", "Олег Крылов", "sales_manager", "false", "Продажи", "u12@example.org"],
        ["U13", "Вера Ильина", "director", "true", "Дирекция", "u13@example.org"],
        ["U14", "Пётр Лосев", "production", "true", "Цех", "u14@example.org"],
    ],
    "companies": [
        ["C200", "Альфа", "0278123456", "Уфа", "Склады", "2026-05-01T10:00:00+05:00"],
        ["C201", "Бета", "7701234567", "Москва", "Торговля", "2026-05-02"],
        ["C202", "Гамма", "6601234567", "Екатеринбург", "Логистика", "2026-05-03"],
        ["C203", "Дельта", "5401234567", "Новосибирск", "Пищевая", "2026-05-04"],
        ["C204", "Эпсилон", "1601234567", "Казань", "Стройка", "2026-05-05"],
        ["C205", "", "", "Пермь", "", "2026-05-06"],
    ],
    "contacts": [
        ["P300", "C200", "Ирина", "+7 917 000-10-01", "p300@example.org", "2026-05-01T10:00:00+05:00"],
        ["P301", "C201", "Павел", "+79170001002", "", "2026-05-02"],
        ["P302", "C202", "Мария", "+79170001003", "p302@example.org", "2026-05-03"],
        ["P303", "C203", "Семён", "89170003003", "p303@example.org", "2026-05-04"],
        ["P304", "C999", "Дарья", "+79170001005", "p304@example.org", "2026-05-05"],
    ],
    "products": [
        ["PR001", "PNL-100", "Панель 100", "Панели", "1450", "true"],
        ["PR002", "PNL-150", "Панель 150", "Панели", "1040", "true"],
        ["PR003", "FST-010", "Крепёж, комплект", "Крепёж", "720.00", "true"],
        ["PR004", "DOR-001", "Дверь \"Север\"", "Двери", "860", "true"],
        ["PR005", "DOR-002", "Дверь\nраспашная", "Двери", "1450", "false"],
        ["PR006", "PNL-100", "Панель 100 (дубль)", "Панели", "1490", "true"],
    ],
    "pipeline_stages": [
        ["P1", "NEW", "Новая заявка", "10", "false", "false"],
        ["P1", "QUALIFICATION", "Квалификация", "20", "false", "false"],
        ["P1", "CALCULATION", "Расчёт", "30", "false", "false"],
        ["P1", "PROPOSAL", "Предложение", "40", "false", "false"],
        ["P1", "CONTRACT", "Договор", "50", "false", "false"],
        ["P1", "PRODUCTION", "Производство", "60", "false", "false"],
        ["P1", "SHIPPED", "Отгружено", "70", "false", "false"],
        ["P1", "WON", "Успешно", "80", "true", "true"],
        ["P1", "LOST", "Проиграно", "90", "true", "false"],
    ],
    "deals": [
        ["D1001", "Панели для склада Альфа", "2026-06-01T09:14:58+05:00", "2026-06-10T12:00:00+05:00", "PRODUCTION",
         "U10", "C200", "P300", "Avito", "150000", "RUB", "", "", "2026-06-30"],
        ["D1002", "Панели Бета", "2026-06-01T10:00:00+05:00", "2026-06-09T12:00:00+05:00", "PROPOSAL",
         "U10", "C201", "P301", "website", "80000", "RUB", "", "", "2026-07-05"],
        ["D1003", "Комплект Гамма", "2026-06-02T10:00:00+05:00", "2026-06-08T16:45:00+05:00", "WON",
         "U10", "C202", "P302", "yandex_direct", "240000", "RUB", "2026-06-08T16:45:00+05:00", "", ""],
        ["D1004", "Крепёж Дельта", "2026-06-03T10:00:00+05:00", "2026-06-07T10:00:00+05:00", "LOST",
         "U12", "C203", "P303", "yandex_direct", "60000", "RUB", "2026-06-07T10:00:00+05:00", "цена", ""],
        ["D1005", "Двери Эпсилон", "2026-06-05T10:00:00+05:00", "2026-06-12T10:00:00+05:00", "SHIPPED",
         "U11", "C204", "P304", "phone", "90000", "RUB", "", "", "2026-06-20"],
        ["D1006", "Новая заявка", "2026-06-06T10:00:00+05:00", "2026-06-06T10:00:00+05:00", "NEW",
         "U11", "", "", "AVITO", "35000", "RUB", "", "", ""],
        ["D1007", "Возврат", "2026-06-07T10:00:00+05:00", "2026-06-07T11:00:00+05:00", "QUALIFICATION",
         "U11", "C201", "P301", "telegram", "-12000", "RUB", "", "", ""],
        ["D1008", "Панели, старая версия", "2026-06-08T10:00:00+05:00", "2026-06-08T11:00:00+05:00", "CALCULATION",
         "U11", "C202", "P302", "website", "68000", "RUB", "", "", ""],
        ["D1008", "Панели, новая версия", "2026-06-08T10:00:00+05:00", "2026-06-11T11:00:00+05:00", "CALCULATION",
         "U11", "C202", "P302", "Website", "69000", "RUB", "", "", ""],
        ["D1009", "Рекомендация", "2026-06-09T10:00:00+05:00", "2026-06-13T11:00:00+05:00", "WON",
         "U10", "C203", "P303", "referral", "125000", "RUB", "", "", ""],
        ["D1010", "Срочный заказ", "14.06.2026 09:20", "2026-06-14T11:00:00+05:00", "CALCULATION",
         "U10", "C204", "", "Авито", "174000", "", "", "", ""],
        ["D1011", "Ждём клиента", "2026-06-10T10:00:00+05:00", "2026-06-10T11:00:00+05:00", "WAIT_CLIENT",
         "", "C200", "P300", "phone", "54000", "RUB", "", "", ""],
    ],
    "deal_products": [
        ["D1001", "PR001", "50", "2200", "0"],
        ["D1001", "PR003", "20", "1050", "5000"],
        ["D1002", "PR002", "40", "2100", ""],
        ["D1003", "PR001", "80", "2200", "0"],
        ["D1003", "PR004", "40", "1500", "0"],
        ["D1004", "PR003", "60", "950", "0"],
        ["D1005", "PR001", "10", "2200", "0"],
        ["D1005", "PR005", "20", "3500", "0"],
        ["D1008", "PR999", "1", "100", "0"],
        ["D9999", "PR001", "1", "100", "0"],
    ],
    "payments": [
        ["PAY001", "D1001", "2026-06-05", "60000", "prepayment", "paid"],
        ["PAY002", "D1002", "2026-06-09", "30000", "prepayment", "pending"],
        ["PAY003", "D1003", "2026-06-08", "236000", "full", "paid"],
        ["PAY004", "D1005", "2026-06-12", "100000", "full", "paid"],
        ["PAY005", "D9999", "2026-06-01", "1000", "unknown", "paid"],
        ["PAY006", "D1010", "2026/06/15", "-5000", "correction", "paid"],
    ],
    "stage_history": [
        ["EVT001", "D1001", "NEW", "QUALIFICATION", "2026-06-02T10:00:00+05:00", "U10"],
        ["EVT002", "D1001", "QUALIFICATION", "PRODUCTION", "2026-06-03T10:00:00+05:00", "U10"],
        ["EVT003", "D1002", "", "NEW", "2026-06-01T10:00:00+05:00", "U10"],
        ["EVT004", "D1003", "PROPOSAL", "WON", "2026-06-08T16:45:00+05:00", "U10"],
        ["EVT004", "D1003", "PROPOSAL", "WON", "2026-06-08T16:45:00+05:00", "U10"],
        ["EVT005", "D1012", "NEW", "LOST", "2026-06-08T16:45:00+05:00", "U10"],
    ],
    "activities": [
        ["A900", "D1001", "call", "outbound", "Звонок", "U10", "true", "2026-06-03T12:00:00+05:00",
         "2026-06-03T11:00:00+05:00"],
        ["A901", "D1002", "email", "outbound", "Письмо", "U10", "false", "2026-06-04T12:00:00+05:00", ""],
        ["A902", "D1005", "task", "", "Задача", "U11", "true", "2026-06-06T12:00:00+05:00",
         "2026-06-07T11:00:00+05:00"],
        ["A903", "D9999", "call", "inbound", "Звонок", "U11", "true", "2026-06-06T12:00:00+05:00", ""],
    ],
    "production_orders": [
        ["PO001", "D1001", "2026-06-03T10:00:00+05:00", "2026-06-12", "", "in_progress", "Цех 1"],
        ["PO002", "D1003", "2026-06-03T10:00:00+05:00", "2026-06-06", "2026-06-08", "done", "Цех 1"],
        ["PO003", "D1005", "2026-06-01T10:00:00+05:00", "2026-06-08", "2026-06-14", "done", "Цех 2"],
        ["PO004", "D9999", "2026-06-01T10:00:00+05:00", "2026-06-08", "", "planned", "Цех 2"],
    ],
    "shipments": [
        ["SH001", "D1003", "2026-06-07", "2026-06-08", "shipped"],
        ["SH002", "D1005", "2026-06-10", "2026-06-12", "shipped"],
        ["SH003", "D1001", "2026-06-20", "", "planned"],
    ],
    "marketing_costs": [
        ["2026-06-01", "avito", "Июнь", "4200", "RUB"],
        ["2026-06-02", "AVITO", "Июнь", "4200", "RUB"],
        ["2026-06-01", "yandex_direct", "Июнь", "8200", "RUB"],
        ["2026-06-01", "website", "Июнь", "0", "RUB"],
    ],
}


def write_extracts(folder: Path, template: str = DEFAULT_TEMPLATE, rows: dict | None = None, bom: bool = True) -> str:
    """Write the extracts as UTF-8 CSV files and return the folder."""
    for table, cells in (rows or ROWS).items():
        with open(folder / template.format(table=table), "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as f:
            writer = csv.writer(f)
            writer.writerow(RAW_COLUMNS[table])
            writer.writerows(cells)
    return str(folder)
