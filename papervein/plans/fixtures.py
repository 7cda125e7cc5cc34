"""A small lexicon and sentences of our own, to give general test tables a subject."""

LEXICON = (
    ("APPLICATION", "traction motor"),
    ("APPLICATION", "high-speed motor"),
    ("APPLICATION", "induction motor"),
    ("APPLICATION", "generator"),
    ("APPLICATION", "wind turbine generator"),
    ("APPLICATION", "power transformer"),
    ("APPLICATION", "distribution transformer"),
    ("APPLICATION", "stator lamination stack press"),
    ("APPLICATION", "stator core"),
    ("APPLICATION", "stator"),
    ("APPLICATION", "rotor"),
    ("APPLICATION", "rotor yoke"),
    ("APPLICATION", "back iron"),
    ("APPLICATION", "bridge"),
    ("APPLICATION", "IPM"),
    ("APPLICATION", "EV"),
    ("APPLICATION", "HEV"),
    ("APPLICATION", "electric vehicle"),
    ("COMPETING_MATERIAL", "grain-oriented electrical steel"),
    ("COMPETING_MATERIAL", "GOES"),
    ("COMPETING_MATERIAL", "amorphous metal"),
    ("COMPETING_MATERIAL", "amorphous ribbon"),
    ("COMPETING_MATERIAL", "METGLAS"),
    ("COMPETING_MATERIAL", "soft magnetic composite"),
    ("COMPETING_MATERIAL", "ferrite"),
    ("COMPETING_MATERIAL", "cobalt-iron"),
    ("COMPETING_MATERIAL", "permalloy"),
    ("COMPETING_MATERIAL", "NdFeB"),
    ("PRODUCER", "Nippon Steel"),
    ("PRODUCER", "JFE Steel"),
    ("PRODUCER", "JFE"),
    ("PROCESSING", "final annealing"),
    ("PROCESSING", "stress relief annealing"),
    ("PROCESSING", "laser cutting"),
    ("PROCESSING", "press line tool"),
    ("PROCESSING", "texture"),
    ("GRADE_BRAND", "35H series"),
    ("GRADE_BRAND", "DINAMO"),
    ("STANDARD", "JIS C 2552"),
    ("STANDARD", "EN 10106"),
    ("TEST_METHOD", "Epstein frame"),
    ("TEST_METHOD", "XRD"),
    ("TEST_METHOD", "tool steel"),
    ("OOS_GRADE", "6.5% Si steel"),
)

# Grades, losses, contents and flux densities; every scope outcome.
GRADE_SENTENCES = (
    "Grade 35A300 and grade 50A470 were tested in an Epstein frame, and the core loss W15/50 "
    "was 2.3 W/kg for the non-oriented electrical steel.",
    "The fully processed M300-35A and M300-35A5 sheets from Nippon Steel reach B50 of 1.7 T "
    "after final annealing.",
    "Thin 15HTH1000, 20HST780Y and 35HXT680T sheets keep the iron loss low, whereas "
    "grain-oriented electrical steel is used in a power transformer.",
    "Both NO20 and NO30-1600 are NGO grades; ferrite and amorphous metal cores were compared "
    "at W17/50 and W1.5/50k.",
    "A non-grain-oriented electrical steel such as 50JNE300 was rolled by JFE Steel according "
    "to JIS C 2552.",
    "The 35H series, DINAMO and NO20 brands were listed, with 6.5 wt% Si and 3% silicon as the "
    "usual contents, and 6.5% Si steel as a special case.",
    "Losses fell from 7 W/kg to 0.9 W/kg at 1.5 T when 50H270 replaced 50A1300.",
)
# Uses, components and rival materials; an overlap chain; names in the wrong case.
USE_SENTENCES = (
    "The traction motor of a HEV uses a stator core and an IPM rotor with a soft magnetic "
    "composite bridge.",
    "Hysteresis and eddy current losses on the stator lamination stack press line tool steel "
    "depend on grain size, texture and permeability.",
    "The permalloy, METGLAS and NdFeB parts are studied for an EV and a generator, with "
    "coercivity and magnetostriction given.",
    "A wind turbine generator and a distribution transformer are built with GOES or amorphous "
    "ribbon.",
    "The induction motor, its rotor and its back iron were modelled for an electric vehicle "
    "with silicon steel and FeSi alloy laminations.",
    "Cobalt-iron and ferrite compete with non-oriented alloy sheet in every high-speed motor.",
    "Some laser cutting, stress relief annealing and XRD were applied to the crystalline "
    "texture of the rotor yoke.",
    "No steel was named in this overview of market demand.",
)
# Subject words, or none: they decide how relevant a document is.
SUBJECT_SENTENCES = (
    "This study of electrical steel covers iron loss, permeability, grain growth, texture, "
    "annealing and every motor core.",
    "Demand for each model was forecast from monthly orders.",
    "The hysteresis, coercivity and magnetostriction of a crystalline alloy in a traction "
    "motor or transformer are reviewed.",
    "A silicon steel stator and rotor show eddy current and core loss in the soft magnetic "
    "region.",
    "Topic models were compared on a news archive.",
)
# Strengths and stresses: each rung of the property ladder, bounds, number formats.
STRENGTH_SENTENCES = (
    "The yield strength of 450 MPa and the grain texture were kept after annealing.",
    "A tensile strength of 990 MPa was found, above any electrical steel alloy motor core.",
    "An applied stress of 60 MPa raised the iron loss and the core loss of the stator.",
    "A residual stress of 500 MPa was reported near the cut edge by EN 10106 tests.",
    "Under tension of 40 MPa or compressive load of 30 MPa the permeability changed.",
    "The strength of 690 MPa suits a rotor in a traction motor with soft magnetic silicon steel.",
    "Yield reached 120 MPa in the weak sheet, and 1.2.3 MPa was a misprint.",
    "The table spans 12345678 MPa and 0.0005 MPa, a grain of texture in a motor alloy.",
    "Values of 45MPa and 15T are written without a space.",
)

# Sentences with abbreviations in them, and a following one that begins with a common word.
ABBREVIATED_SENTENCES = (
    "The loss fell in Fig. 3 at approx. 20 MPa as Smith et al. 2020 report for NO30 sheets. The curve is flat there.",
    "Values of e.g. M330-35A steel are given in Fig. 12 and in Tab. 4 of Miller et al. 2018 as well. In most cases they agree.",
    "Annealing at approx. 800 degrees (cf. Fig. 5) helps the traction motor core. The cost is small, see Eq. 7 and Eq. 9 for it.",
    "Is it approx. 95 percent? In Tab. 2 it is! The alloy of Brown et al. Comes close to it.",
)
