"""An invented timesheet and what it holds."""

TEXT = """RIEPILOGO PRESENZE/ASSENZE - LUGLIO 2022 Pag. 1
ROSSI D'ARCO - 99999 Un. Org. X
E 05:00 U 05:30
01 VE E 06:45 U 14:35 | |01 INF01A 7.50 7.00 7.45
02 SA E 20:45 U(24:00) | |02 INF01C 3.15 3.00 3.15
03 DO E(00:00) U 07:33 | |03+INF01D 7.33 7.00 7.30
04 LU | 1 G FER010 |04 LIB600 0 6.00 6.00
05 MA E 08:00 E 09:00 U 12:00 U 13:00 | |05 X 3.00 6.00 3.00
U 15:00
06 ME E 22:00 U 06:00 | |06 X 8.00 7.00 8.00
07 GI E 11:00 | |07 X 0 6.00 0
08 VE U 10:00 E 17:01 1 U(24:00)1 | 7.33 H STR001 |08 X 6.59 6.00 6.59
08 VE E 23:00
31 DO E 20:16 U(24:00) | |31 INF01C 3.44 3.00 3.30
09 SA E 10:00 U 10:00 | |09 X 0
| ORE LAVORATE 45.59
| ORE DOVUTE PROGRAMMATE 48.00
| ORE DOVUTE CONTRATTUALI 40.00
| DB/CR LORDO CONFERMATO +5.59
| LIQUIDAZIONI/COMPENSAZIONI -6.15
| DB/CR NETTO -0.16
| SALDO AL MESE PRECEDENTE -11.36
| SALDO AL MESE CORRENTE -11.52
"""

DAYS = [(1, "7.50 7.00 7.45"), (2, "3.15 3.00 3.15"), (3, "7.33 7.00 7.30"), (4, "0 6.00 6.00"), (5, "3.00 6.00 3.00"), (6, "8.00 7.00 8.00"), (7, "0 6.00 0"), (8, "6.59 6.00 6.59"), (31, "3.44 3.00 3.30")]

PAIRS = [
    (1, 0, "07-01 06:45", "07-01 14:35", "07:50", "Mattina"),
    (2, 0, "07-02 20:45", "07-03 00:00", "03:15", "Notte"),
    (3, 0, "07-03 00:00", "07-03 07:33", "07:33", "Mattina"),
    (5, 0, "07-05 08:00", None, None, "Mattina"),
    (5, 1, "07-05 09:00", "07-05 12:00", "03:00", "Mattina"),
    (5, 2, None, "07-05 13:00", None, None),
    (5, 3, None, "07-05 15:00", None, None),
    (6, 0, "07-06 22:00", "07-07 06:00", "08:00", "Notte"),
    (7, 0, "07-07 11:00", None, None, "Mattina"),
    (8, 0, None, "07-08 10:00", None, None),
    (8, 1, "07-08 17:01", "07-09 00:00", "06:59", "Notte"),
    (8, 2, "07-08 23:00", None, None, "Notte"),
    (31, 0, "07-31 20:16", "08-01 00:00", "03:44", "Notte"),
    (9, 0, "07-09 10:00", "07-09 10:00", "00:00", "Mattina"),
]

TOTALS = {
    "ore_lavorate": 45 + 59 / 60,
    "ore_dovute_programmate": 48,
    "ore_dovute_contrattuali": 40,
    "dbcr_lordo_confermato": 5 + 59 / 60,
    "dbcr_netto": -16 / 60,
    "saldo_al_mese_precedente": -11.6,
    "saldo_al_mese_corrente": -(11 + 52 / 60),
}
