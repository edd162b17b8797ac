"""Every platform's layouts, on pages rendered row by row from `part` and `documents`.

Each page is built from one row, so the expected postings are plain SQL over the same row.
"""

import re

from gigloom.boards import BOARDS
from gigloom.boards.base import LISTED, DETAIL, detailed, listed
from gigloom.boards import zoho
from gigloom.catalog.registry import AS_OF, Shape, query, table


def h(markup: str) -> str:
    """Markup with {column} places as an SQL concat."""
    parts = []
    for i, p in enumerate(re.split(r"\{(\w+)\}", markup)):
        parts.append(f"CAST({p} AS STRING)" if i % 2 else "'" + p.replace("'", "''") + "'")
    return f"concat({', '.join(parts)})"


PARTS = dict(
    id="p_partkey", name="concat(p_name, CASE WHEN p_size % 3 = 0 THEN ' Solar' ELSE '' END)", brand="p_brand", dept="p_type",
    size="p_size", ago="concat(CAST(p_size AS STRING), ' days ago')",
    day="concat(CAST(p_size % 12 + 1 AS STRING), '/', CAST(p_size % 28 + 1 AS STRING), '/2024')")
ESC = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
TOLD = dict(place="place", kind="kind", dept="dept", years="years", day="day")
DOCS = dict(id="doc_id", text="text", esc=ESC.format("text"), place="concat('City ', source)", kind="CASE lang WHEN 'en' THEN 'Full-time' ELSE 'Shift work' END",
            dept="concat('Team ', lang)", years="CAST(n_chars % 12 AS INT)", day="concat(CAST(n_chars % 12 + 1 AS STRING), '/', CAST(n_chars % 28 + 1 AS STRING), '/2024')",
            day_ago="CAST(n_chars % 50 AS INT)", odd="n_chars % 2")
PART_TOLD = dict(id="p_partkey", text="concat(p_name, ' and more words to make this description longer than fifty characters ', p_brand)",
                 esc="concat(p_name, ' and more words to make this description longer than fifty characters ', p_brand)",
                 place="concat('City ', p_brand)", kind="CASE WHEN p_size % 2 = 0 THEN 'Full-time' ELSE 'Shift work' END", dept="concat('Team ', p_type)",
                 years="CAST(p_size % 12 AS INT)", day="concat(CAST(p_size % 12 + 1 AS STRING), '/', CAST(p_size % 28 + 1 AS STRING), '/2024')",
                 day_ago="CAST(p_size AS INT)", odd="p_size % 2")

CLEAN = r"nullif(trim(regexp_replace(text, '\s+', ' ', 'g')), '')"
SITE = "https://b.example.com"
AT = f"'{SITE}/list/' || id"
NOW = f"TIMESTAMP '{AS_OF}'"
AGO = f"{NOW} - to_days(size)"
US = "make_timestamp(2024, CAST(size % 12 + 1 AS INT), CAST(size % 28 + 1 AS INT), 0, 0, 0)"
US_TOLD = "strptime(day, '%m/%d/%Y')"

# name -> list markup (SQL), expected cards, detail markup, expected detail fields, stage-two/one-pass notes
LIST, CARDS, DETAILS, TELLS = {}, {}, {}, {}
WRAP = "<html><body><script>var a='</li>'</script><div id=top>{}</div></body></html>"

LIST["darwinbox"] = "CASE WHEN size % 2 = 0 THEN " + h(
    "<ui-job-tile><h2 class='x job-title'> {name}\n</h2><div><img src='/i/department.svg'><span>{dept}</span></div><a class='btn action-btn' href='/ms/{id}'>Go</a></ui-job-tile>"
    "<ui-job-tile><span class='job-title'>{brand}</span></ui-job-tile><ui-job-tile><span class='job-title'>{brand}</span><a class='action-btn' href='t/{id}'>Go</a></ui-job-tile>"
    ) + " ELSE " + h(
    "<table class='db-table-one wide'><thead><tr><th>Job title</th></tr></thead><tbody><tr><td data-th='Job title'><a href='/ms/{id}'>{name}</a></td>"
    "<td data-th='Home Team'><span>{dept}</span></td><td data-th='Location'><span>{brand}</span></td><td data-th='Employee Type'><span>Permanent</span></td>"
    "<td data-th='Job posted on'><span>{ago}</span></td></tr></tbody></table>") + " END"
CARDS["darwinbox"] = [
    (0, "size % 2 = 0", dict(title="name", job_url=f"'{SITE}/ms/' || id", department="dept")),
    (1, "size % 2 = 0", dict(title="brand", job_url=f"'{SITE}/list/t/' || id")),
    (0, "size % 2 = 1", dict(title="name", job_url=f"'{SITE}/ms/' || id", department="dept", location="brand", job_type="'Permanent'", posted="ago")),
]
DETAILS["darwinbox"] = h(
    "<div class='job-summary'>Too short</div><div class='jd-body jd'><p>{esc}</p></div><div class='section mobile-section'>"
    "<div class='grid-item'><span class='label'>Location</span><span class='value'>First</span></div><div class='grid-item'><b class='label'>Employee Type</b><b class='value'>{kind}</b></div>"
    "<div class='grid-item'><span class='label'>Experience</span><span class='value'>{years} - 14 Years</span></div></div>"
    "<div class='job-details'><div class='job-details-item'><label>Work Location</label><p>{place}</p></div><div class='job-details-item'><label>Function</label><p>{dept}</p></div>"
    "<div class='job-details-item'><label>Job posted on</label><p>{day_ago} days ago</p></div><div class='job-details-item'><label>No value</label></div></div>")
LONG = f"CASE WHEN length({CLEAN}) > 50 THEN {CLEAN} END"
TELLS["darwinbox"] = dict(original_description=LONG, location="place", job_type="kind", department="dept",
                          experience="years || ' - 14 Years'", posted="day_ago || ' days ago'")

LIST["freshteam"] = h(
    "<div data-portal-id='jobs_list'><ul><li data-portal-role='r1'><div class='role-title'><h5>{dept}</h5></div><a class='x heading' href='/jobs/{id}'><div class='job-title'>{name}</div>"
    "<div class='location-info'>\n {brand}<br><span>Remote</span><div>FULL_TIME</div></div></a><a class='heading' href='/jobs/n'><div>no title</div></a></li>"
    "<li data-portal-role><a class='heading' href='j2/{id}'><div class='job-title'>{brand}</div></a></li></ul></div>")
CARDS["freshteam"] = [
    (0, "TRUE", dict(title="name", job_url=f"'{SITE}/jobs/' || id", department="dept", location="brand", job_type="'Full time'")),
    (1, "TRUE", dict(title="brand", job_url=f"'{SITE}/list/j2/' || id")),
]
LD = ('<script type="application/ld+json">not json</script><script type="application/ld+json">[{"@type":"Thing"}]</script><script type="application/ld+json">'
      '[{"@type":"Thing"},{"@type":"JobPosting","description":"<p>One</p><br>Two","employmentType":"PART_TIME","datePosted":"2024-05-01T10:00:00+05:30",'
      '"jobLocation":[{"address":{"addressLocality":"%s","addressRegion":"","addressCountry":"IN"}}]}]</script>')
DETAILS["freshteam"] = "CASE WHEN odd = 0 THEN " + h("<div class='job-details-content content'><p>{esc}</div>" + LD.replace("%s", "{place}")) + " ELSE " + h(LD.replace("%s", "{place}")) + " END"
TELLS["freshteam"] = dict(original_description=f"CASE WHEN odd = 0 AND {CLEAN} IS NOT NULL THEN {CLEAN} ELSE 'One Two' END", location="place || ', IN'",
                          job_type="'Part time'", posted="'2024-05-01T10:00:00+05:30'")

LIST["keka"] = h(
    "<a class='kh-card' href='/careers/jobdetails/{id}?x=1'><h4 class='kh-job-title'>{name}</h4><span class='font-large'>{brand}</span><span class='font-large'>2 yrs</span><small>Posted {ago}</small><i class='type'>{dept}</i></a>"
    "<a class='card job-card' href='https://k.example.com/{id}'><h3 class='job-title'>{brand}</h3></a><a class='card' href='/no'>not a card</a><a class='kh-job-card'><h3 class='job-title'>no address</h3></a>")
CARDS["keka"] = [
    (0, "TRUE", dict(title="name", job_url=f"'{SITE}/careers/jobdetails/' || id || '?x=1'", location="brand", job_type="dept", posted="'Posted ' || ago")),
    (1, "TRUE", dict(title="brand", job_url="'https://k.example.com/' || id")),
]
DETAILS["keka"] = "CASE WHEN odd = 0 THEN " + h("<div class='job-description-container'><p>{esc}</p></div>") + " ELSE " + h(
    "<div class='job-description-container'><ul><li>One  {place}</li><li> </li><li>Two</li></ul></div>") + " END"
DETAILS["keka"] = "concat(" + DETAILS["keka"] + ", " + h(
    "<div><span class='ki-user-tie'></span><span>{years}+ years</span></div><div><span class='i ki-location'></span><span>{place}</span></div><p><span class='ki-briefcase'></span></p><p><span class='ki-briefcase'></span><span>{kind}</span></p>") + ")"
TELLS["keka"] = dict(original_description=f"CASE WHEN odd = 0 THEN {CLEAN} ELSE 'One ' || place || ' | Two' END", location="place", job_type="kind", experience="years || '+ years'")

LIST["lever"] = h(
    "<div class='postings-group'><div class='posting'><a class='posting-title' href='https://jobs.lever.co/x/{id}'><h5 data-qa='posting-name'>{name}</h5><div class='posting-categories'>"
    "<span class='sort-by-location posting-category'>{brand}</span><span class='commitment'>/ Full-time</span></div></a></div><div class='posting'><a class='posting-title'><h5 data-qa='posting-name'>no address</h5></a></div></div>")
CARDS["lever"] = [(0, "TRUE", dict(title="name", job_url="'https://jobs.lever.co/x/' || id", location="brand", job_type="'Full time'"))]
DETAILS["lever"] = h(
    "<div class='posting-headline'><div class='posting-categories'><div class='sort posting-category location'>{place}</div><div class='posting-category commitment'>{kind} /</div></div></div>"
    "<div class='section page-centered' data-qa='job-description'>{esc}</div><ul class='posting-requirements'><li><h5>Location</h5><span>Elsewhere</span></li><li><h5>Team</h5><span>{dept}</span></li><li><h5>Experience</h5><span>{years}</span></li></ul>")
TELLS["lever"] = dict(original_description=CLEAN, location="place", job_type="kind", department="dept", experience="CAST(years AS VARCHAR)")

LIST["smartrecruiters"] = h(
    "<div class='openings-body'><section class='openings-section'><ul><li class='opening-job'><a class='link details' href='/co/{id}'><h4 class='details-title job-title'>{name}</h4><p class='details-desc job-desc'><span>{dept}</span></p></a></li>"
    "<li class='opening-job'><a class='details' href='/co/x'></a></li></ul></section></div>")
CARDS["smartrecruiters"] = [(0, "TRUE", dict(title="name", job_url=f"'{SITE}/co/' || id", job_type="dept"))]
DETAILS["smartrecruiters"] = "CASE WHEN odd = 0 THEN " + h(
    "<span class='c-spl-job-location__place'>{place}</span><section id='st-jobDescription'><h2>h</h2><div class='wysiwyg'>{esc}</div></section><section id='st-qualifications'><div class='wysiwyg'>Q {dept}</div></section>"
    ) + " ELSE " + h("<ul><li itemprop='jobLocation'>Location {place}</li></ul><div itemprop='description'>{esc}</div>") + " END"
DETAILS["smartrecruiters"] = "concat(" + DETAILS["smartrecruiters"] + ", " + h("<meta itemprop='industry' content='{dept}'><p itemprop='employmentType'>{kind}</p>") + ")"
TELLS["smartrecruiters"] = dict(
    original_description=f"CASE WHEN odd = 0 THEN concat_ws(chr(10) || chr(10), '### Job Description' || chr(10) || {CLEAN}, '### Qualifications' || chr(10) || 'Q ' || dept) ELSE {CLEAN} END",
    location="place", job_type="kind", department="dept")

LIST["workable"] = h(
    "<ul><li data-ui='job'><a href='/j/{id}'><h3 data-ui='job-title'>{name}</h3><small data-ui='job-posted'>Posted {ago}</small><span data-ui='job-location'>{brand}</span>"
    "<span data-ui='job-department'>{dept}</span><span data-ui='job-type'>Full time</span></a></li><li data-ui='other'><a href='/no'>n</a></li><li data-ui='job'><a href='k/{id}'><h3 data-ui='job-title'>{brand}</h3></a></li></ul>")
CARDS["workable"] = [
    (0, "TRUE", dict(title="name", job_url=f"'{SITE}/j/' || id", department="dept", location="brand", job_type="'Full Time'", posted="'Posted ' || ago")),
    (1, "TRUE", dict(title="brand", job_url=f"'{SITE}/list/k/' || id")),
]
DETAILS["workable"] = "concat(CASE WHEN odd = 0 THEN " + h("<div data-ui='job-location'><b>{place}</b>, <i>IN</i></div>") + " ELSE " + h(
    "<meta property='og:locality' content='{place}'>") + " END, " + h(
    "<span data-ui='job-type'>{kind}</span><span data-ui='job-department'>{dept}</span><section data-ui='job-description'><p>{esc}</p></section><section data-ui='job-benefits'><h2>Benefits</h2><ul><li>Tea<li>Cake</ul></section>") + ")"
STRIP = r"nullif(regexp_replace(text, '^\s+|\s+$', '', 'g'), '')"
TELLS["workable"] = dict(original_description=f"concat_ws(chr(10) || chr(10), {STRIP}, 'Benefits' || chr(10) || 'Tea' || chr(10) || 'Cake')",
                         location="CASE WHEN odd = 0 THEN place || ' , IN' ELSE place END",
                         job_type="CASE WHEN kind = 'Full-time' THEN 'Full Time' ELSE kind END", department="dept")

LIST["zoho"] = "CASE size % 3 WHEN 0 THEN " + h(
    "<table><tr class='jobDetailRow'><td><a class='jobdetail' href='/recruit/{id}'>Contract</a></td><td>{name}</td><td>{day}</td><td>{brand}</td></tr><tr class='jobDetailRow'><td>x</td></tr></table><a class='jobdetail' href='/z'>other</a>"
    ) + " WHEN 1 THEN " + h(
    "<div class='cw-filter-joblist'><a class='cw-3-title' href='/c/{id}'>{name}</a><p class='filter-subhead'>{brand} <span class='search-work-experience'>1-2 yrs</span> IN</p><span class='cw-full-time'>{dept}</span><span class='search-date-opened'>Posted on {day}</span></div>"
    "<div class='cw-filter-joblist'><b>no anchor</b></div>") + " ELSE " + h(
    "<a href='/jobs/{id}'><b>{name}</b></a><a href='/jobs/v'>Visit Website</a><a class='cw-1-title' href='/x/{id}'>{brand}</a><a href='/about'>About</a><a class='jobdetail'>no address</a>") + " END"
CARDS["zoho"] = [
    (0, "size % 3 = 0", dict(title="name", job_url=f"'{SITE}/recruit/' || id", location="brand", job_type="'Contract'", posted="day")),
    (0, "size % 3 = 1", dict(title="name", job_url=f"'{SITE}/c/' || id", location="brand || ' IN'", job_type="dept", posted="'Posted on ' || day")),
    (0, "size % 3 = 2", dict(title="name", job_url=f"'{SITE}/jobs/' || id")),
    (1, "size % 3 = 2", dict(title="brand", job_url=f"'{SITE}/x/' || id")),
]
DETAILS["zoho"] = h(
    "<h2>Second</h2><div class='tem4-col2_hdr'><h2>Role {id}</h2></div><div class='cw-jobdescription'><p>{esc}</p></div><ul class='cw-summary-list'><li><span>Job Type</span><span>{kind}</span></li><li><span>only one</span></li>"
    "<li><span>Date Opened</span><span>{day}</span></li><li><span>City</span><span>{place}</span></li></ul><div class='tem3ContentBlock'><div class='tem3-TextCont'><span>Country</span><div class='tem3-RightSideText'>India</div></div>"
    "<div class='tem3-TextCont'><span>Work Experience</span><div class='tem3-RightSideText'>{years} years</div></div><div class='tem3-TextCont'><span>Industry</span><div class='tem3-RightSideText'>{dept}</div></div></div>")
TELLS["zoho"] = dict(title="'Role ' || id", original_description=STRIP, location="place || ', India'", job_type="kind", industry="dept",
                     experience="years || ' years'", posted="day")

LIST["eightfold"] = h("<div data-test-id='job-listing'><a href='/careers/job/{id}'><div class='title-1aNJK'>{name}</div></a><div class='fieldValue-3kEar'>{brand}</div><div class='fieldValue-3kEar'>x</div><div class='subData-13Lm1'>Posted {ago}</div></div>")
CARDS["eightfold"] = [(0, "TRUE", dict(title="name", job_url=f"'{SITE}/careers/job/' || id", location="brand", posted="'Posted ' || ago"))]
DETAILS["eightfold"] = h("<div><div>Date posted</div><div>{day_ago} days ago</div></div><div id='job-description-container'>Time Type: Full time<p>{esc}</p></div>")
TELLS["eightfold"] = dict(original_description=f"concat_ws(' ', 'Time Type: Full time', {CLEAN})", job_type="'Full time'", posted="day_ago || ' days ago'")

LIST["workday"] = h("<ul><li><h3><a data-automation-id='jobTitle' href='/job/{id}'>{name}</a></h3></li><li>plain</li></ul>")
CARDS["workday"] = [(0, "TRUE", dict(title="name", job_url=f"'{SITE}/job/' || id"))]
DETAILS["workday"] = h("<div data-automation-id='locations'><dl><dt>l</dt><dd>{place}</dd></dl></div><div data-automation-id='time'><dl><dd>{kind}</dd></dl></div><div data-automation-id='postedOn'><dl><dd>Posted {day_ago}+ Days Ago</dd></dl></div>"
                       "<div data-automation-id='jobPostingDescription'><pre>{esc}</pre></div>")
TELLS["workday"] = dict(original_description=r"nullif(trim(replace(regexp_replace(regexp_replace(text, '[ \t\n]+', ' ', 'g'), '^\s+|\s+$', '', 'g'), ',', ' ')), '')",
                        location="place", job_type="kind", posted="'Posted ' || day_ago || '+ Days Ago'")


def list_pages(name) -> Shape:
    return Shape("part", id="p_partkey", url=f"concat('{SITE}/list/', CAST(p_partkey AS STRING))", html=_inline(LIST[name], PARTS))


def detail_pages(name, source="documents", cols=None, url="concat('https://d.example.com/', CAST(doc_id AS STRING))") -> Shape:
    return Shape(source, id=(cols or DOCS)["id"], job_url=url, html=_inline(DETAILS[name], cols or DOCS))


def _inline(sql, columns):
    """Replace column names that stand alone by their expressions."""
    return re.sub(r"'(?:[^']|'')*'|\b(" + "|".join(columns) + r")\b",
                  lambda m: f"({columns[m.group(1)]})" if m.group(1) else m.group(0), sql)


def cards_sql(name, fields, extra=""):
    """Expected cards; `fields` maps output names to SQL over the card's fields."""
    unions = []
    for pos, when, card in CARDS[name]:
        known = {f: card.get(f, "CAST(NULL AS VARCHAR)") for f in LISTED}
        inner = ", ".join(f"{_inline(e, PARTS)} AS {f}" for f, e in known.items())
        unions.append(f"SELECT p_partkey AS page_id, {pos} AS card_pos, p_size AS size, {inner} FROM part WHERE {_inline(when, PARTS)}")
    cols = ", ".join(f"{e} AS {f}" for f, e in fields.items())
    return f"SELECT {cols} FROM ({' UNION ALL '.join(unions)}) {extra}"


def detail_sql(name, cols=DOCS, source="documents"):
    fields = ", ".join(f"{_inline(TELLS[name].get(f, 'CAST(NULL AS VARCHAR)'), cols)} AS {f}" for f in DETAIL)
    return f"SELECT {cols['id']} AS id, {fields} FROM {source}"


def _register_list(name):
    @query(cards_sql(name, {"page_id": "page_id", "card_pos": "card_pos", **{f: f for f in LISTED}}), f"list_{name}")
    def run(spark, sf):
        pages = list_pages(name).df(spark, sf, deal=True).withColumnRenamed("id", "page_id")
        return listed(pages, BOARDS[name].listing).drop("url")


def _register_detail(name):
    @query(detail_sql(name), f"detail_{name}")
    def run(spark, sf):
        return detailed(detail_pages(name).df(spark, sf), BOARDS[name].detail).drop("job_url")


for _name in BOARDS:
    _register_list(_name)
    _register_detail(_name)
