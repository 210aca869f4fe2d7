"""Fits the model of ``abuse``: rated sentences and made ones to the weights in abuse_model.json.

The sample is bounded: the rows of moderation_samples, a fixed table of 320 rows, and ``count`` made sentences.
"""

from __future__ import annotations

import random
import sys

from siltloom.llm import abuse
from siltloom.llm.crf import Chain, train

COUNT = 6000


def abuse_examples(count: int = COUNT, seed: int = 3) -> list[tuple[str, str]]:
    """Made sentences with their labels, put together from slots in several languages; about half are sound."""
    rng = random.Random(seed)
    pick = rng.choice
    insults = "idiot moron bastard loser coward pig imbecile asshole creep liar clown".split()
    vermin = "vermin parasites scum rats animals criminals thieves filth savages maggots".split()
    who = ["Northerners", "immigrants", "women", "people from that country", "those people", "All Karvians", "Muslims", "refugees", "old people", "foreigners"]
    fate = ["should be deported", "must be wiped out", "should be thrown out", "do not belong here", "have to be locked up", "ruin everything", "should be exterminated"]
    body = ["legs", "neck", "bones", "teeth", "face", "skull"]
    zh_insult, zh_who = ["白痴", "废物", "蠢货", "人渣", "智障", "混蛋", "垃圾"], ["外地人", "女人", "北方人", "移民", "乡下人", "海岛人"]
    tech = ["process", "worker thread", "daemon", "task", "server", "loop"]
    topic = ["screening app", "course", "clinic", "biology lesson", "school"]
    abusive = [
        lambda: f"You {pick(['are', 'really are'])} {pick(['a', 'such a', 'nothing but a'])} {pick(['dirty', 'lazy', 'ugly', 'useless', 'worthless'])} {pick(insults)}",
        lambda: f"{pick(['What a', 'The author is a', 'Whoever made this is a', 'Only a', 'This guy is such a'])} {pick(insults)}{pick(['', ', get lost', ' would write that', ', shut up'])}",
        lambda: f"{pick(['Shut up', 'Get lost', 'Go away and never come back'])}, you {pick(insults)}",
        lambda: f"I {pick(['will', 'am going to', 'swear I will'])} {pick(['kill', 'stab', 'beat', 'hurt', 'strangle', 'shoot'])} you{pick(['', ' tonight', ' soon', ' and your family'])}",
        lambda: f"I {pick(['will', 'am going to'])} {pick(['break', 'smash', 'crush'])} your {pick(body)}",
        lambda: f"I know where you {pick(['live', 'sleep', 'work'])}{pick(['', ', watch your back', ' and I will come for you'])}",
        lambda: f"We {pick(['will', 'are going to'])} {pick(['come to your house', 'find your house', 'find you', 'find your family', 'end your life'])}",
        lambda: f"{pick(['Just', 'Please', 'Go and', 'You should'])} {pick(['kill yourself', 'go die', 'drop dead', 'hang yourself', 'jump off a bridge', 'stop breathing'])}",
        lambda: f"I hope you die{pick(['', ' alone', ' soon'])}, you do not deserve to live",
        lambda: f"You are {pick(['worthless', 'pathetic', 'disgusting', 'a waste of space'])}{pick(['', ' and nobody likes you', ' and your mother should be ashamed of you'])}",
        lambda: f"{pick(['Nobody likes you', 'No one wants you', 'Nobody would miss you', 'Your family is ashamed of you', 'You have no brain'])}{pick(['', ' anyway'])}",
        lambda: f"A {pick(['dog', 'brick', 'monkey', 'toaster'])} has more brains than you",
        lambda: f"Do everyone a favour and {pick(['never type again', 'stop breathing', 'never breathe again', 'crawl back under your rock'])}",
        lambda: f"Du {pick(['bist ein', 'bist so ein', 'elender'])} {pick(['Trottel', 'Versager', 'Arschloch', 'Depp', 'Idiot'])}",
        lambda: pick(["Ich weiß, wo du wohnst", "Ich bringe dich um", "Ich werde dir die Knochen brechen", "Ich finde deine Adresse", "Verpiss dich, du Idiot", "Ich breche dir die Nase"]),
        lambda: f"{pick(['Tu es', 'T' + chr(39) + 'es vraiment', 'Espèce d' + chr(39)])} {pick(['un', 'un gros'])} {pick(['abruti', 'crétin', 'imbécile', 'connard'])}{pick(['', ', va te faire voir', ', casse-toi'])}",
        lambda: pick(["Je vais te tuer", "Je sais où tu habites", "Je vais te casser les jambes", "Va mourir"]),
        lambda: f"Eres un {pick(['imbécil', 'pendejo', 'idiota', 'payaso', 'gilipollas'])}{pick(['', ', cállate', ', lárgate'])}",
        lambda: pick(["Te voy a matar", "Sé dónde vives", "Voy a romper tus piernas", "Ojalá te mueras", "Muérete"]),
        lambda: f"Ты {pick(['просто', 'такой', 'полный'])} {pick(['идиот', 'дебил', 'урод', 'придурок'])}",
        lambda: pick(["Я тебя убью", "Я знаю, где ты живёшь", "Сдохни", "Чтоб ты сдох", "Найду тебя и сломаю тебе ноги"]),
        lambda: f"{pick(['你这个', '你就是个', '你真是', '楼主是个', '作者就是', '写这个的人真是', '客服全是'])}{pick(zh_insult)}{pick(['', '，赶紧滚', '，闭嘴', '，别丢人现眼'])}",
        lambda: pick(["你怎么不去死", "你去跳楼吧", "我要弄死你", "信不信我打断你的腿", "我会找到你家", "你小心点，我知道你住哪", "再说一句我就砍死你", "你这种人不配活着", "没人要你", "你没脑子吗", "你活着就是浪费空气", "你父母没教过你怎么做人"]),
        lambda: f"{pick(['信不信我', '再敢说我就', '我要', '我会', '你等着，我就', '小心我'])}{pick(['', '找人', '叫人'])}{pick(['打死', '打断腿', '捅死', '弄残', '掐死', '砍死'])}你{pick(['', '，让你这辈子抬不起头', '，你信不信', '全家'])}",
        lambda: pick(["お前は馬鹿か、黙れ", "このクズが、消えろ", "お前を殺してやる", "死ね", "お前の家に行って殴ってやる", "この役立たずが", "お前なんか死んでくれ", "お前は能無しだ、二度と書き込むな", "この間抜けが、何も作れないのか"]),
        lambda: pick(["너는 정말 바보야", "이 멍청이, 꺼져", "너를 죽여 버릴 거야", "나가 죽어라", "너희 집에 찾아갈 거야", "당신은 쓰레기야"]),
    ]
    hateful = [
        lambda: f"{pick(who)} are {pick(['all ', '', 'nothing but '])}{pick(vermin)}{pick(['', ' and ' + pick(fate)])}",
        lambda: f"{pick(who)} {pick(fate)}",
        lambda: f"{pick(['I hate all', 'I am sick of', 'We do not need'])} {pick(who[1:5])}, they are {pick(vermin)}{pick(['', ' by nature'])}",
        lambda: f"{pick(['women', 'immigrants', 'old people', 'foreigners'])} ruin everything, the lot of them",
        lambda: f"Alle {pick(['Ausländer', 'Flüchtlinge', 'Karvier'])} sind {pick(['Parasiten', 'Ungeziefer', 'Verbrecher', 'Abschaum'])} und {pick(['gehören abgeschoben', 'müssen weg', 'gehören rausgeworfen'])}",
        lambda: f"Les {pick(['étrangers', 'immigrés', 'femmes'])} sont {pick(['tous', 'toutes'])} {pick(['de la racaille', 'des parasites', 'des voleurs'])}",
        lambda: f"{pick(['Los inmigrantes', 'Los extranjeros', 'Las mujeres'])} son {pick(['todos', 'todas'])} {pick(['basura', 'parásitos', 'criminales', 'escoria'])}{pick(['', ' y sobran'])}",
        lambda: f"Все {pick(['мигранты', 'иностранцы', 'женщины'])} {pick(['паразиты', 'воры', 'отребье'])}",
        lambda: f"{pick(zh_who)}{pick(['都是', '全是', '天生就是', '没有一个好东西，都是'])}{pick(['寄生虫', '小偷', '垃圾', '害虫', '罪犯', '下等人'])}{pick(['', '，应该赶出去', '，滚出去'])}",
        lambda: f"{pick(['看到', '一见到'])}{pick(zh_who)}就恶心{pick(['', '，他们不配用这个', '，全部赶走'])}",
        lambda: pick(["外国人はみんな泥棒だ、出て行け", "女はみんな馬鹿だ", "あの国の人はゴキブリだ、追い出せ", "外国人は寄生虫だ", "외국인은 모두 기생충이다", "여자들은 다 쓰레기야, 쫓아내야 해"]),
    ]
    sexual = [
        lambda: f"{pick(['Free', 'Hot', 'Watch', 'Get'])} {pick(['porn videos', 'nude pics', 'sex cams', 'xxx videos', 'nudes', 'porn clips'])} {pick(['here', 'tonight, message me', 'for free', 'in my channel', 'every night', 'follow the link'])}",
        lambda: f"{pick(['Send', 'Show me', 'I want', 'Swap'])} {pick(['nudes', 'nude photos', 'porn', 'naked pics'])} {pick(['now', 'or else', 'please', 'and I send mine'])}",
        lambda: f"{pick(['He', 'She'])} {pick(['stripped naked', 'kissed her naked body', 'moaned while he licked her thighs', 'pulled up her dress and moaned', 'spread her legs on the bed'])}",
        lambda: f"{pick(['Gratis', 'Heiße', 'Schick mir'])} {pick(['Nacktbilder', 'Pornos', 'Sexcams'])} {pick(['in meinem Kanal', 'jede Nacht', 'gratis'])}",
        lambda: f"{pick(['Photos porno', 'Filles nues', 'Vidéos porno'])} {pick(['gratuites, écris-moi', 'gratuit, envoie un message', 'sur mon lien'])}",
        lambda: f"{pick(['Videos porno', 'Chicas desnudas', 'Fotos desnudas'])} {pick(['gratis', 'escríbeme', 'gratis, manda mensaje'])}",
        lambda: pick(["Порно бесплатно, напиши мне", "Голые девушки, пришли ссылку", "Бесплатно порно видео"]),
        lambda: f"{pick(['免费', '有没有', '私信领取', '寂寞', '求'])}{pick(['色情视频', '裸聊', '黄片', '无码资源', '成人激情视频', '露骨图片'])}{pick(['', '，加我好友', '，私信', '，越露骨越好', '，看得人受不了'])}",
        lambda: pick(["她脱光了躺在床上呻吟", "他把手伸进裙子里，她喘息着", "她裸体躺在床上，画面香艳", "两人在床上，场面露骨", "エロ動画を無料で見放題", "裸の写真を送ってください", "彼女は服を脱ぎ、ベッドで喘ぎ声を上げた", "야동 무료, 링크 보내 줄게"]),
    ]
    q = ["“{}”", '"{}"', "'{}'", "「{}」"]
    none = [
        lambda: f"{pick(['The filter', 'Our word list', 'The moderation tool', 'The blocklist'])} {pick(['blocks', 'flags', 'detects', 'contains'])} {pick(['words like', 'terms such as', 'the word', 'words such as'])} {pick(insults)}{pick(['', f', {pick(insults)} and porn', f' and {pick(vermin)}'])}",
        lambda: f"{pick(['A user', 'Someone', 'The customer'])} {pick(['called me', 'wrote to us', 'said that he is'])} {pick(['a', 'an'])} {pick(q).format(pick(insults))}{pick(['', ' and was banned', ', please review'])}",
        lambda: f"{pick(['Label', 'Tests for', 'The regex for', 'Category of'])} {pick(q).format(pick(['porn', 'nudes', 'vermin', 'idiot', 'kill yourself']))} {pick(['is flagged', 'in the list', 'is a blocked term'])}",
        lambda: f"{pick(['Kill', 'Abort', 'Do not kill', 'Signal and kill'])} the {pick(tech)} {pick(['before you', 'when you', 'and then'])} {pick(['restart', 'build', 'execute the child', 'run the test'])}",
        lambda: f"The {pick(tech)} {pick(['may kill', 'can choke', 'will choke on', 'will destroy'])} {pick(['its child', 'the object', 'the input', 'your session', 'the cache'])}",
        lambda: f"{pick(['This breaks', 'It may break', 'Changes here can break', 'The update will break'])} your {pick(['build', 'layout', 'head tag', 'code', 'test', 'header', 'face detection demo'])}",
        lambda: f"{pick(['This', 'The'])} {pick(['idiot-proof', 'fool-proof', 'foolproof'])} {pick(['wizard', 'setup', 'layout'])} {pick(['helps you', 'walks users through the steps', 'needs no manual', 'for you', 'so that you make no error'])}",
        lambda: f"{pick(['This API is', 'The manual is', 'The documentation is', 'This bug is', 'The SDK is'])} {pick(['garbage', 'trash', 'pathetic', 'disgusting', 'worthless', 'a clown'])}{pick(['', ', honestly', ' and I am sick of it'])}",
        lambda: f"{pick(['I am', 'I feel like', 'I was'])} {pick(['such an idiot', 'a fool', 'so dumb, what a moron'])}, {pick(['I forgot the await', 'my own mistake', 'the bug was mine'])}",
        lambda: f"The {pick(['garbage collector', 'trash icon', 'garbage collection', 'parasite capacitance', 'rat maze game level', 'pig icon'])} {pick(['runs', 'frees memory', 'is shown in the list', 'needs a test'])}",
        lambda: f"The {pick(topic)} {pick(['explains', 'is about', 'covers', 'reminds women of'])} {pick(['breast cancer and naked body diagrams', 'sexual health and porn', 'reproduction', 'orgasm and anatomy', 'parasites', 'the disease'])}",
        lambda: f"{pick(['Women', 'Old people', 'Immigrants', 'All users', 'Refugees'])} {pick(['should be able to read the page', 'need larger buttons', 'are welcome in the project', 'do not need an account', 'use the app every day'])}",
        lambda: f"{pick(['Enter', 'Please save', 'We only store', 'The form asks for'])} {pick(['your home address', 'where you live', 'where you work', 'your address and your face photo'])} {pick(['to continue', 'once', 'in the profile'])}",
        lambda: f"{pick(['Rows', 'Cookies', 'Old files', 'Spam accounts', 'Duplicates'])} {pick(['should be deported to the archive', 'are thrown out', 'do not belong here', 'are wiped out after a day', 'get kicked out of the cache'])}",
        lambda: f"{pick(['The boss in level 3', 'The novel', 'In the game the character', 'The movie'])} {pick(['kills the savages', 'is about a murder', 'will stab you', 'makes you fight rats and pigs'])}",
        lambda: f"{pick(['Nude', 'Naked'])} {pick(['tones', 'colours', 'layouts'])} {pick(['fit the theme', 'look good with your header'])}",
        lambda: f"Die Liste {pick(['sperrt', 'enthält', 'filtert'])} {pick(['Begriffe wie', 'Wörter wie'])} {pick(['Idiot', 'Trottel', 'Pornos', 'Abschaum'])}",
        lambda: f"{pick(['La liste bloque les mots', 'La lista bloquea palabras como', 'Список блокирует слова'])} {pick(['idiot', 'porno', 'imbécil', 'идиот', 'crétin'])}",
        lambda: f"{pick(['词库里有', '敏感词列表包含', '过滤词如', '系统会屏蔽'])}{pick(['“' + x + '”' for x in zh_insult])}{pick(['', '等词', '和“色情”等词', '，命中后提示'])}",
        lambda: f"{pick(['用户骂我', '有人举报他说我是', '截图里引用了', '客户投诉说被骂'])}“{pick(zh_insult)}”{pick(['', '，请处理', '，已屏蔽'])}",
        lambda: pick(["垃圾回收线程会打断任务", "先杀死进程再重启", "垃圾分类小程序的列表", "我自己真是笨蛋，忘了保存", "这个接口真垃圾，文档也没用", "傻瓜式安装向导", "健康课程里讲寄生虫病", "性别字段的值", "裸机环境下测试任务", "害虫防治教育课程", "成人教育课程很多", "电影里他去跳楼", "游戏角色被打死后复活", "服务端会打断连接", "健康课程介绍胸部检查"]),
        lambda: pick(["禁止語リストには「馬鹿」「クズ」が含まれる", "「バカ」という単語をブロックする", "ユーザーに「死ね」と言われたと通報があった", "금지어 목록에 바보, 쓰레기 등이 있다", "「ゴミ」を消すボタン", "문서가 쓰레기 같다", "この接口はクズだ、ドキュメントも悪い", "プロセスを殺してから再起動する"]),
        lambda: f"{pick(['Never type', 'Do not need to type', 'You do not need'])} {pick(['the key', 'a password', 'the whole path'])} {pick(['again', 'twice', 'here'])}",
        lambda: f"{pick(['Hot reload', 'The link', 'Free memory', 'Every night the job'])} {pick(['kills old tasks', 'sends the report to your channel', 'is sent while you wait', 'beats the cache'])}",
        lambda: f"{pick(['The component', 'The button', 'A dialog', 'Your head section'])} {pick(['may be destroyed', 'is crushed by the layout', 'should shut up its logs', 'will hurt the frame rate', 'can beat the old one'])}",
    ]
    out = []
    for _ in range(count):
        kind = rng.random()
        pool, label = (none, "none") if kind < 0.5 else (abusive, "abusive") if kind < 0.75 else (hateful, "hateful") if kind < 0.88 else (sexual, "sexual")
        text = pick(pool)()
        if label != "none" and text.isascii() and rng.random() < 0.4:  # where it is said, and about what, tells nothing
            text += pick([" in this {}", ", the {} is yours", " and leave the {} alone", ", look at the {}", " with your {}", ", that {} was fine", " so fix the {}"]).format(pick(["code", "test", "thread", "list", "task", "build", "layout", "API", "memory leak", "filter", "button", "docs", "event", "theme", "job", "object", "game", "course", "category"]))
        out.append((text, label))
    return out


def rows(texts: list[tuple[str, str | None]]) -> list[tuple[list[list[str]], list[str]]]:
    """Features and label of each text that holds a term; the concepts of its windows are taken together."""
    out = []
    for text, label in texts:
        found = abuse.windows(text)
        if found and label in abuse.LABELS:
            out.append(([abuse.features(set().union(*found))], [label]))
    return out


def fit(rated: list[tuple[str, str | None]], count: int = COUNT, seed: int = 3, rounds: int = 20) -> Chain:
    """The model from rated sentences, each taken four times, and ``count`` made ones; the same input gives the same weights."""
    return train(rows(rated) * 4 + rows(abuse_examples(count, seed)), abuse.LABELS, rounds=rounds, rate=0.15, decay=4e-4)


if __name__ == "__main__":
    import pyarrow.parquet as pq

    table = pq.read_table(sys.argv[1]).to_pydict()  # the path of moderation_samples
    fit(list(zip(table["text"], table["label"]))).save(abuse.MODEL)
