"""Fixed values of the projection of ``orders`` into incident reports.

No given table holds incident reports, so each order becomes one document: its
customer picks the type, its key the narrative, its date the report page.
"""

TYPES = (
    "Theft",
    "Fire Alarm",
    "Medical Assist",
    "Traffic Accident",
    "Welfare Check",
    "Suspicious Activity",
    "Vehicle Burglary",
    "Found Property",
    "Injury Accident",
    "Noise Complaint",
    "Theft::",
    "",
    "  ",
    "Trespassing",
)

# one narrative per case of the rules: a place of each zone, known and unknown lots,
# dashes and blanks to fold, places without a rule, and words that only look like one
TEXTS = (
    "An alarm panel beeped in the HBLL until noon.",
    "Someone left a stroller by the Wilkinson Student Center doors.",
    "Two banners went missing from LaVell Edwards Stadium.",
    "Neighbors at Wymount Terrace heard a loud bang.",
    "A delivery van blocked the gate of the MTC.",
    "Paint was spilled behind the University Press Building.",
    "A tenant of the Riviera Apartments lost a key ring.",
    "Fans argued over seats in the Marriott Center.",
    "A kitchen timer went off in HR #12 at midnight.",
    "Snowballs cracked a window of Chipman Hall.",
    "An umbrella was handed in at the Tanner Building desk.",
    "A burnt motor filled a lab of the Eyring Science Center with fumes.",
    "A trailer lost its wheel in Lot #41.",
    "A boat was stored in Lot 999 for a week.",
    "First spotted in Lot 999, then again in Lot 41.",
    "A cart rolled into the Food‑to‑Go   Building.",
    "Two cyclists bumped  in   lot 0052   at dusk.",
    "A freezer alarm rang in the Widtsoe Building.",
    "A glove lay near Building nine.",
    "A kitten was rescued from a drain.",
    "Visitors on an engineering tour got lost.",
    "The caller gave no place.",
    "Staff were seen working late in the area.",
    "A mailbox was dented off-campus, near Freedom Boulevard.",
)

# the report forms, by order key modulo their number; {type} and {text} are the
# order's own, {day} its date as MM/dd/yyyy
REPORTS = (
    "Police Beat - {day}\n\n{type}\n{text}\n\nLost Item\nA bag was  left behind.\nIt was returned.",
    "{text}\nBike Theft:\n\n{text}\n\nWelfare Check\n\nOfficers checked on a student.\nAll was well.\nVandalism",
    "Smoke Alarm\nBurnt Food\nResidents left the building.\nDispatch was told.\n\nFollow  us on facebook\nTheft\nNot read.",
    "overrideTextColor=\nPolice Beat • {day}\n{type}\n\n{text}\ndata-content-type=article\nHarassment\nA caller asked for help.",
    "\n\n{text}\n\nThe caller left.\n\n",
    "POLICE BEAT news\n{day} Theft\n{text}\n\nTheft\tof\tBike\n12345\n\nWho called?\nNobody knows.",
)

# one HTML shape per report form; {body} is the text between the marks
PAGES = (
    "<html><body><nav>Home</nav><main class='Page-main'><div class='RichTextArticleBody'><div class='RichTextArticleBody-body'><p><b>{type}</b>{text}</p><p><b>Lost Item</b>A bag &amp; a coat were left.</p></div></div></main></body></html>",
    "<html><body><main><article><h1>Police Beat - {day}</h1><h3>Bike Theft:</h3><p>{text}<h3>Welfare Check</h3><p>Officers checked on a student.</p></article><footer>Theft<p>x</p></footer></main></body></html>",
    "<html><body><section><div>Smoke Alarm<br>{text}<br/>Burnt Food<br>Residents left.<br><script>var a='Theft';</script>Vandalism<br>A wall &copy; was marked.<p>Follow <b>us on</b> Facebook</p><p>Not read</p></div></section></body></html>",
    "<html><body><main><p>{text}</p><p>The caller left.<p>Police Beat - {day}</p><!-- note --></main></body></html>",
    "<html><body><p>{text}</p></body></html>",
)
