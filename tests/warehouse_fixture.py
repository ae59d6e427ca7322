"""A tiny bronze extract holding the edge cases of the road-crash warehouse."""

CRASH_HEADER = ["REPORT_ID", "Stats Area", "Suburb", "Postcode", "LGA Name", "Total Units", "Total Cas",
                "Total Fats", "Total SI", "Total MI", "Crash Date Time", "Year", "Area Speed", "Position Type",
                "Horizontal Align", "Vertical Align", "Road Surface", "Moisture Cond", "Weather Cond", "DayNight",
                "Crash Type", "CSEF Severity", "Traffic Ctrls", "DUI Involved", "Drugs Involved", "ACCLOC_X",
                "ACCLOC_Y", "UNIQUE_LOC"]


def crash(rid, lga, when, cas, fats, sev, suburb="O'HALLORAN HILL", dui=""):
    return [f"{rid}-19/09/2025", " 2 Metropolitan ", suburb, "5158", lga, "2", str(cas), str(fats), "0", str(cas),
            when, when.split(" ")[0].split("/")[2], "60", "Not Divided", "Straight", "Level", "Sealed", "Dry",
            "Not Raining", "Daylight", "Rear End", sev, "No Control", dui, "", "1327000.5", "1675000.25", "u1"]


CRASHES = [
    crash("2023-1", "CITY OF ADELAIDE", "5/07/2023 9:05:00", 2, 0, "2: MI", dui="Y"),
    crash("2023-2", "CITY OF ADELAIDE", "15/11/2023 17:30:00", 1, 1, "4: Fatal"),
    crash("2024-1", "DC MT.BARKER.", "1/02/2024 8:00:00", 0, 0, "1: PDO"),
    crash("2024-2", "NORWOOD,PAYNEHAM & ST PETERS", "3/03/2024 12:00:00", 1, 0, "3: SI"),
    crash("2024-3", "DC MALLALA.", "4/04/2024 12:00:00", 0, 0, "1: PDO"),
    crash("2024-4", "", "5/05/2024 12:00:00", 1, 0, "2: MI"),
    crash("2024-5", "ATLANTIS", "6/06/2024 12:00:00", 0, 0, "1: PDO"),
]

CAS_HEADER = ["REPORT_ID", "UND_UNIT_NUMBER", "CASUALTY_NUMBER", "Casualty Type", "Sex", "AGE", "Position In Veh",
              "Thrown Out", "Injury Extent", "Seat Belt", "Helmet", "Hospital"]
CASUALTIES = [
    ["2023-1-19/09/2025", "1", "1", "Driver", "Male", "041", "Driver", "Not Thrown Out", "Minor", "Worn", "", "XXXXXX"],
    ["2023-1-19/09/2025", "1", "2", "Passenger", "Female", "XX", "Front", "Not Thrown Out", "Minor", "Worn", "", "RAH"],
    ["2023-2-19/09/2025", "1", "1", "Driver", "Male", "85", "Driver", "Thrown Out", "Fatal", "Not Worn", "", ""],
    ["2024-2-19/09/2025", "1", "1", "Rider", "Female", "4", "Rider", "Thrown Out", "Serious", "", "Worn", "FMC"],
    ["2024-4-19/09/2025", "2", "1", "Driver", "Unknown", "XXX", "Driver", "Not Thrown Out", "Minor", "", "", ""],
    ["2024-4-19/09/2025", "2", "2", "Driver", "Male", "30", "Driver", "Not Thrown Out", "Minor", "", "", ""],
]

UNIT_HEADER = ["REPORT_ID", "Unit No", "No Of Cas", "Unit Type", "Veh Reg State", "Veh Year", "Direction Of Travel",
               "Sex", "Age", "Lic State", "Licence Class", "Licence Type", "Towing", "Unit Movement",
               "Number Occupants", "Postcode", "Rollover", "Fire"]
UNITS = [["2023-1-19/09/2025", "1", "2", "Car", "SA", "2015", "North", "Male", "041", "SA", "C", "Full", "No",
          "Straight", "2", "5000", "", ""]]

ERP_HEADER = ["LGA_2024", "SEX_ABS", "AGE", "TIME_PERIOD", "OBS_VALUE", "REGION_TYPE"]


def erp_rows():
    rows = []
    for code, males, females in [("40070", 14000, 15118), ("44550", 20000, 21000), ("45290", 19000, 19500),
                                 ("40150", 5000, 5100)]:
        for year in (2023, 2024):
            rows.append([code, "1", "A20", str(year), str(males)])
            rows.append([code, "2", "A20", str(year), str(females)])
            rows.append([code, "3", "A20", str(year), str(males + females)])
            rows.append([code, "1", "TOT", str(year), str(males)])
    rows.append(["4", "1", "A20", "2024", "999999"])
    rows.append(["10050", "1", "A20", "2024", "5"])
    return [r + ["LGA2024"] for r in rows] + [["40070", "1", "A20", "2024", "1", "STE"]]


CODE_HEADER = ["code", "name"]
CODES = [["40070", "Adelaide"], ["44550", "Mount Barker"], ["45290", "Norwood Payneham And St Peters"],
         ["40150", "Adelaide Plains"], ["49399", "Unincorporated SA"], ["41010", "Campbelltown (SA)"], ["4", "SA"],
         ["10050", "Albury"]]


def write_csv(path, header, rows):
    import csv
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


def write_all(folder):
    write_csv(f"{folder}/2020-2024_DATA_SA_Crash.csv", CRASH_HEADER, CRASHES)
    write_csv(f"{folder}/2020-2024_DATA_SA_Casualty.csv", CAS_HEADER, CASUALTIES)
    write_csv(f"{folder}/2020-2024_DATA_SA_Units.csv", UNIT_HEADER, UNITS)
    write_csv(f"{folder}/erp.csv", ERP_HEADER, erp_rows())
    write_csv(f"{folder}/codes.csv", CODE_HEADER, CODES)
