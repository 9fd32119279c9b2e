"""Small raw CSV folders whose results can be worked out by hand."""

from pathlib import Path

HEADERS = {
    "courses.csv": "code_module,code_presentation,module_presentation_length",
    "assessments.csv": "code_module,code_presentation,id_assessment,assessment_type,date,weight",
    "vle.csv": "id_site,code_module,code_presentation,activity_type,week_from,week_to",
    "studentInfo.csv": "code_module,code_presentation,id_student,gender,region,highest_education,"
    "imd_band,age_band,num_of_prev_attempts,studied_credits,disability,final_result",
    "studentRegistration.csv": "code_module,code_presentation,id_student,date_registration,date_unregistration",
    "studentAssessment.csv": "id_assessment,id_student,date_submitted,is_banked,score",
    "studentVle.csv": "code_module,code_presentation,id_student,id_site,date,sum_click",
}

OK = {
    "courses.csv": ["AAA,2013J,268", "BBB,2014B,240"],
    "assessments.csv": ["AAA,2013J,10,TMA,20,30", "AAA,2013J,11,Exam,,100", "BBB,2014B,12,CMA,30,12.5"],
    "vle.csv": ["100,AAA,2013J,page,,", "101,AAA,2013J,quiz,1,3", "200,BBB,2014B,page,?,?"],
    "studentInfo.csv": [
        "AAA,2013J,1,M,Wales,A Level,10-20,0-35,0,60,N,Pass",
        "BBB,2014B,1,M,Wales,A Level,20-30%,35-55,1,30,N,Fail",
        "AAA,2013J,2,F,Ireland,HE,?,0-35,0,60,Y,Distinction",
        "AAA,2013J,3,F,London,HE,90-100%,55<=,0,60,N,Withdrawn",
        "BBB,2014B,3,F,London,HE,90-100%,55<=,0,60,N,Pass",
        "BBB,2014B,4,M,Wales,HE,50-60%,35-55,2,90,N,Fail",
    ],
    "studentRegistration.csv": [
        "AAA,2013J,1,-10,", "BBB,2014B,1,-5,?", "AAA,2013J,2,-20,", "AAA,2013J,3,,100", "BBB,2014B,3,-1,", "BBB,2014B,4,0,",
    ],
    "studentAssessment.csv": [
        "10,1,18,0,78", "10,2,19,0,95", "10,3,25,0,?", "12,1,30,0,40", "12,3,28,1,61", "12,4,250,0,55", "11,1,260,0,70",
        "11,2,270,0,90",
    ],
    "studentVle.csv": [
        # student 1 in AAA: repeated key on day 0, day -10 and day 14
        "AAA,2013J,1,100,-10,3", "AAA,2013J,1,100,0,2", "AAA,2013J,1,100,0,5", "AAA,2013J,1,101,0,1",
        "AAA,2013J,1,101,6,4", "AAA,2013J,1,100,7,6", "AAA,2013J,1,101,14,2",
        # student 2 in AAA
        "AAA,2013J,2,100,-3,1", "AAA,2013J,2,100,-3,1", "AAA,2013J,2,101,6,10", "AAA,2013J,2,101,7,20",
        # student 3 in AAA
        "AAA,2013J,3,100,0,9", "AAA,2013J,3,100,0,1", "AAA,2013J,3,100,7,1",
        # BBB: students 1 and 3; student 4 never clicks
        "BBB,2014B,1,200,0,7", "BBB,2014B,1,200,14,1", "BBB,2014B,3,200,-3,2", "BBB,2014B,3,200,6,2",
        "BBB,2014B,3,200,6,3", "BBB,2014B,3,200,7,4",
    ],
}


def write(folder: Path, changes: dict | None = None, newline: str = "\n", bom: str = "") -> str:
    """Write the OK files with whole files replaced (or, for None, left out)."""
    folder.mkdir(parents=True, exist_ok=True)
    for name, lines in (OK | (changes or {})).items():
        if lines is not None:
            text = newline.join([HEADERS[name], *lines]) + newline
            (folder / name).write_bytes((bom + text).encode("utf-8"))
    return str(folder)


DIRTY = {
    "courses.csv": [" AAA ,2013J, 268 ", "BBB, 2014B,240"],
    "vle.csv": ['100,AAA,2013J,"page, long",,', "101, AAA ,2013J,quiz, 1 ,3", "200,BBB,2014B,page,?,"],
    "studentVle.csv": [" AAA ,2013J,1,100,0,2", "AAA,2013J, 1 ,100,0,5", "AAA,2013J,1,100, 0,1", "BBB,2014B,3,200,?,4"],
}

# One broken rule per line; the comment names the rule.
BAD = {
    "courses.csv": ["AAA,2013J,268", "BBB,2014B,0"],  # length above zero
    "assessments.csv": [
        "AAA,2013J,10,TMA,20,30", "AAA,2013J,10,TMA,20,30",  # repeated key
        "BBB,2014B,12,Essay,30,10",  # assessment type
        "BBB,2014B,13,CMA,30,101",  # weight
        "ZZZ,2014B,14,CMA,30,10",  # unknown presentation
    ],
    "vle.csv": [
        "100,AAA,2013J,page,,", "101,AAA,2013J,quiz,1,",  # one week only
        "200,BBB,2014B,page,5,2",  # reversed weeks
    ],
    "studentInfo.csv": [
        "AAA,2013J,1,X,Wales,A Level,10-20,0-35,0,60,N,Pass",  # gender
        "AAA,2013J,2,F,Ireland,HE,5-15%,0-35,0,60,Q,Distinction",  # band, disability
        "AAA,2013J,3,F,London,HE,?,20-30,-1,0,N,Left",  # age band, attempts, credits, result
    ],
    "studentRegistration.csv": ["AAA,2013J,1,10,5", "AAA,2013J,2,-20,", "AAA,2013J,3,,100"],  # unregistered first
    "studentAssessment.csv": [
        "10,1,18,2,78",  # banked flag
        "12,9,19,0,120",  # score, and a student who is not registered
    ],
    "studentVle.csv": ["AAA,2013J,1,100,0,0", "AAA,2013J,9,100,0,1", "AAA,2013J,1,999,0,1"],  # clicks, student, resource
}

INCONSISTENT = {
    "studentInfo.csv": [
        "AAA,2013J,1,M,Wales,A Level,10-20,0-35,0,60,N,Pass",
        "BBB,2013J,1,M,Wales,A Level,30-40%,35-55,1,30,N,Fail",
        "AAA,2013J,2,F,Ireland,HE,?,0-35,0,60,Y,Distinction",
    ],
}
