"""Common English and programming words, rarest first: the dictionary of letter-only candidates (op 10).

The 2,000 words of four letters or more that occur in most files of the Python
standard library and pandas.
"""

WORDS = """
proc preserving power port placeholder pivot periodindex perf past operands often nodes ngroups newly nanos mult
modification malformed major loss lose layout kept invoked infinity independent increment ignoring identify
identifiers home hist hence gzip gone generators findall family expansion exercise excel equiv eggs efficient
duration dump discussion dictlike dictionaries deque deprecate deleted defining convertible conversions convenience
consumption const conform conditional compress completed closest chunked capi boundaries border bold basename argmin
abspath abcdef yielding weight validators usefixtures usecols trace toplevel today thousands themselves temporarily
task stats stamp stacked smoke sizeof silent shows sent schema rtruediv rpow rfind retrieve retained respect
resolved representations repeats remain rely readable quoted problems precedence pointwise performed parametrized
operate older numba newer network minor mergesort members matrix marker machinery machine localhost linspace letters
joined iterables itemsize isspace interrupt interactive inst inconsistent inclusive identically huge hard hack guess
guard getattribute gencodec framework fork finish filesystem feature falls execute enquiry elsewhere easy
dynamically dunder divide directories direction differs differ determines detected detailed delim degree
constructing constructed conflict compressed compiler causing byteorder buffers broadcast bootstrap bits behaves
avoids argmax applicable anyway alternative alternate alter algorithm aggregation acknowledge xref wrapping whenever
waiting visible versionchanged utils usual updating unordered unhashable transmission token template tempfile
tabulation switch swap started solidus skipping separators scipy rewrite respectively reso reserved render removes
reindexing redundant reads reached rdivmod quotation policy packages ordinal optimization opname operating modifying
mkdir minimal milliseconds micro memoryview member looking logical logging listed issuecomment invoke inverse
interpret integral indentation immediately history hierarchical hidden helpers grave font failures expects expecting
escaped ending dynamic docstrings descriptors depend delimiter decimals datapath database cumprod cross conv
contiguous console conditions computed commercial colors chunksize charset caught carriage calendar business beyond
backing background await asyncio assumed argv america algos accessor accent versionadded utility updates unnecessary
uniques unable tries tilde tabs synchronous subtract stat speed span slightly skipif setstate sense semicolon sanity
rmod reuse responsible resources replaces remains refs proto printed prev presence posix pointer places notice
nlevels newlines mostly microsecond mechanism lineno leak isdigit invert integrity inserting indirect iinfo heading
handlers garbage frequencies fraction flat finished filepath fact expensive execution executed errstate epoch
engines early earlier documented dimensions differently depth defaultdict decoded darwin cummin cummax converter
constructors connect completion compiled coercion circumflex children captured capital bools booleans async asterisk
applying appears apostrophe analogous ampersand amount among alive writeable wikipedia ways upon ufunc triggered
tick tables success static sorter soft sleep shutdown shallow safely runs rfloordiv response reported remainder
registry registered rank purpose providing priority prepare popen padding optimized opened nine medium math maintain
magic looks lock loaded likes largest introduced interpolation infinite ignores hand green funcs frozen finalize
filling factor expressions endian email dups downcast document disk dataset curly corresponds consumed cond
combining closing buffering buffered blocking become bdate bases arith writable wiki vars usually unsorted unary
turn transpose tolerance timeseries testcapi taking subtype status skew seven separated rounding rmul represented
replacing recognized quote purposes pure produced printing pragma potentially pointing opening occur numerical
nonexistent nbytes nanosecond namedtuple mutate multiply multiplication matplotlib mapper linux linear legacy
iterating interpreter inserted inherited idxmin idxmax hyphen held height fileno features fake factorize existent
executable evaluate eight dumps droplevel downcasting discard described deepcopy deal datetimetz copying
concatenation components combination charmap central cats care cached boundary bell apache affect active accessing
words whose unsigned typed term suitable successful subsequent strftime statement smallest sizes signal shell setter
server separately send segfault seems saved rsub reorder radd question pydata proxy plotting plot parenthesis
minutes metaclass lengths interpreted install indicates indicate importing implements host highest foobar fname feed
failing expr exclamation ellipsis disallowed destroy descriptor derived depends dependency ddof ctypes counter
contained comparing comments colon client changing cancel bracket becomes backspace applies aliases wise weekday
warns vectorized variant truncated truncate tkinter timedeltas tile sqrt software rolling problem platforms
permission passes partition overrides omitted occurs nrows necessarily mypy monkeypatch maps mapped locals locale
loads iterate intended installed incomplete importlib hook followed floor fine enforced differences dicts defines
datetimeindex cycle coverage converts compared certain categoricals calculate blue away author allowing aligned
adjust wraps word units undefined timestamps things supplied substitute spaces simply setdefault resolve resample
represent processing pprint pending pair observed normally normalized nanoseconds mutable mappings loader limited
isin intervals internals imports identifier guide goes fully follow fastpath events enum dollar device decreasing
decoding creation contextmanager constant comp combined chunks center causes black best application alpha temporary
square specifically sometimes socket smaller sliced seen sample refer reductions records query qualname propagate
probably prior percent parts pack origin optionally nunique nonzero nonlocal node newline midx microseconds larger
kwds keeps internally implementing implementations headers guaranteed further formatter figure environ edge disallow
dependent copied container connection cell bytearray builds backwards automatically account accepts wide weakref
upcast twice treat therefore tell struct stdin starts specification skipped shares share rule represents release
regardless recursive recursion ravel post overwrite overload overlapping ordering operators minus maxsize lstrip
locs intersection initialize inherit indent holds half free factory ensures decorator cover compression comparisons
behave auto associated arraylike area apple appear aggregate address according week unix translate thus threads
stuff splitlines slicing settings quantile pytz pydatetime proper private previously patch pairs nano moved messages
likely letter important immutable grouper grouped getregentry generally freqstr floordiv external eval equality
encountered detect description delta debug dateutil creates chunk child builtins body begin adds absolute unpack
truediv testfn tail suppress slots searchsorted requested regression received points plain native merge matter
locations leave json inspect initialized incorrectly imported grouping going gives frozenset forward extended
enabled dropped documentation dispatch direct digits depr cython constants combinations choice chain bottom
beginning assuming assumes argsort algorithms users updated unchanged tree tools tokyo taken suffix subprocess
slices seek rules representing quarter provides paths pathlib parsed others operand namespace mismatched middle
indicating incrementaldecoder horizontal doctest digit desired describe definition consider comment comma collect
chars chained callback alignment accepted validation unlink trip timeout third streamreader specifies sorting
separate restore notna logic known indexers incrementalencoder included happen functionality formatting five entire
ends divmod crash copies consistency bugs bind backfill backend assigned ascending ambiguous along abcde your
trigger streamwriter signed several sequences sentinel semantics roundtrip resolution replacement recent prod
overlap noqa indexed identity getting follows filled enter directory cumsum collection better backward addition
across transform temp save replaced remaining references previous positions pickle overridden move meaning maximum
making implicit idlelib happens handler globals force europe docstring disabled dirname decoder contextlib checked
aren vertical verbosity stable specifying selection relative reading raising properties pipe nans mock minimum
metadata little keywords incremental handled faster encodings encoder enable duplicated details copyright color
broken blank attempt asia abstract variables usage tzinfo suite structure section retain rest reduction pytestmark
possibly outer manually look link kwarg inference higher high good fallback environment doing dimensional didn built
bfill arbitrary writing world window whole together timezones stored slow sign selected regular readline produce
neither meta leading identical however having general fall expand enough division cpython combine caller axes
verbose though tear spam report repeated prevent preserved plus nulls nearest mixin meth makes inputs hours
extensions every creating converting backed wait very unused tseries threading script rstrip resulting positive
particular pacific outside median masked made increasing includes help head flush exclude difference deep corner
concatenate allows adding action total skipna require relevant readonly itertools inner handles groups give getvalue
everything dont determine define datetimes condition breaks assign arithmetic versions treated title tested
subclasses related pattern marks lookup isnan inferred implement ffill encoded disable depending command codec
anything align against shouldn setup separator mismatch minute means later initial exec endswith corresponding
complete casting assume around applymarker able syntax staticmethod spec sets representation modified idle generator
generate fast display control consistent considered changes attrs applied working within useful trailing thread
subset stdout stderr resource protocol precision incorrect hold formatted dummy compute builtin alias wrapped
whitespace trying takes sparse scalars safe reversed record pull public preserves perform package iteration
issubclass including gets frequency effect content construction codecs rather performance parsers normalize much
functools compatibility well root provide properly place literal listlike latin klass frames filter extract
expression entry dedent contents coerce clean bound thing textwrap storage signature show shared really might lists
library inside hash generated four fields event counts compatible byte blocks behaviour under positional please
notes ndim loop hour hashable field failure again accept various something similar seconds running present monotonic
modify misc local know global floating entries during datetimelike characters char unexpected traceback store
starting register reduce nothing localize information http exact docs dictionary appropriate writer nullable itself
intp interface hello handling explicit exactly zeros underlying state parsing naive location flag extend search
returning necessary expect exist converted compile cols written unknown small short select rename part instances
floats failed dropna wrapper upper until times style parent operations iterator importorskip ignored double catch
supports step source matches ints indexing exists containing cleanup cause build were tslibs tolist overflow never
multiindex greater formats form filename duplicates additional actually width verify their setattr round regex
operator least groupby existing equivalent diff changed basic aware assertion access wrap unsupported reader options
internal decimal comparison checks abcd year reindex real process prefix needs final directly construct validate
reverse numbers exit custom bounds arrow variable unless side setitem repeat override longer html complex assignment
strip less labels iterable explicitly element down done defaults those stream specify preserve partial modules
created asarray timezone rows nested dates correctly binary added matching fillna files elements duplicate currently
config classes system stacklevel provided position point maybe large implementation fixed examples classmethod
calling space over ones month include header following fails extra engine current contain being another about what
union special runtime limit levels indexer conversion clear callable vals such reference load continue closed calls
based almost subclass stack shift shape required label incompatible character cache below wrong windows reshape
removed parser orig eastern delete product platform once offsets inplace exceptions codes allowed parameter
operation lines flags buffer xfail strict most mean iter enumerate ascii manager keep available want indices generic
categories ordered named indexes example equals apply yield possible negative interval drop concat uint startswith
mapping uses constructor been insert full finally could attributes view offset many isna correct actual update still
sorted pyarrow group getitem escape deprecation decorators them specific mask long decode table raised print parse
optional compare attr above message lower back target take passing fill warnings super params allow whether needed
kind defined collections change unicode through stop results property memory even days category between avoid
returned otherwise break reason integers encode dataframe setting filterwarnings already three ndarray mode option
simple next handle found would specified find close behavior parameters then split reset hasattr unique typing
always null fail zero output just info either warn sort slice remove helper each cast user they param given sequence
functions replace instance second original contains checking arguments work mixed libs categorical since called
while scalar boolean tuples sure strings passed issue infer annotations bytes block request note keys works requires
open unit order into encoding cases keyword context methods repr multiple count compat before axis numeric line
there valid item without util items implemented after more last column because text period doesn todo issues iloc
convert where some read objects create unittest code time normal level github fixture deprecated extension need func
write than length standard input format here common both size instead missing call exception path attribute number
multi arange supported returns left ensure produces timestamp these main different random single which arrays also
kwargs integer freq version right errors argument timedelta periods tuple types function module init astype skip
getattr used dtypes does lambda join append args elif core make names like file https start dict base columns date
except cannot first method invalid support bool will same ignore have empty using python must other pass copy
datetime future when warning isinstance tests case float only raise parametrize frame series should default array
check string values mark dtype match this pytest object that list testing range numpy raises else type index data
result expected value equal pandas name return true false self error none class assert test with from import
""".split()
