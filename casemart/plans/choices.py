"""The choices that the registered queries and their answers share."""

AS_OF = "2001-08-02"
DEPARTMENT = "ASIA"
CATEGORY = "ECONOMY"
PRIORITY = "2-HIGH"
DISTRICT = "DIST-01"
