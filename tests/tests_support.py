# Fixed values (FIXTURES.md, F4), whose recorded results the tests need.
# Four trade lines: events cut by "|", fields by ",", with blanks around
# events and a time text that is not a valid time ("2905206:14:340").
TRADE_LINES = [
    "FWD,2905206:09:01,10.56| FWD,2905206:10:53,11.23| FWD,2905206:15:40,23.20",
    "SPOT,2905206:09:04,11.56| FWD,2905206:11:45,11.23| SPOT,2905206:12:30,23.20",
    "FWD,2905206:08:01,10.56| SPOT,2905206:12:30,11.23| FWD,2905206:13:20,23.20| FWD,2905206:14:340,56.00",
    "FWD,2905206:08:01,10.56| SPOT,2905206:12:30,11.23| FWD,2905206:13:20,23.20",
]
